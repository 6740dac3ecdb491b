"""Row and column filters of the study (pure built-in predicates)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polyscore.constants import LAMBDA_GC_BOUNDS, MIN_ALLELE_COUNT, POPS


def lambda_gc_ok(lambda_gc) -> Column:
    """0.5 < lambda_gc < 2, strictly."""
    c = F.col(lambda_gc) if isinstance(lambda_gc, str) else lambda_gc
    lo, hi = LAMBDA_GC_BOUNDS
    return (c > F.lit(lo)) & (c < F.lit(hi))


def filter_membership(df: DataFrame, col: str, values: Iterable | DataFrame, key: str | None = None) -> DataFrame:
    """Literal-set membership (isin) for constants, left-semi join for data-derived lists."""
    if isinstance(values, DataFrame):
        k = key or col
        return df.join(values.select(F.col(k).alias(col)).distinct(), col, "left_semi")
    return df.where(F.col(col).isin(*list(values)))


def min_allele_count(af_map: str = "af", an_map: str = "an", pops: Sequence[str] | None = None,
                     min_count: int = MIN_ALLELE_COUNT) -> Column:
    """af[p] * an[p] >= min_count for at least one population (or the given ones)."""
    ps = F.array(*[F.lit(p) for p in (pops or POPS)])
    return F.exists(ps, lambda p: F.coalesce(
        F.try_element_at(F.col(af_map), p) * F.try_element_at(F.col(an_map), p) >= F.lit(min_count), F.lit(False)))


def clump_text_filter(p="P", low_confidence="low_confidence", high_quality: str | None = None) -> Column:
    """P present; low_confidence not true (NA passes); high_quality not false (NA passes)."""
    cond = F.col(p).isNotNull() & F.coalesce(~F.col(low_confidence), F.lit(True)) if low_confidence else F.col(p).isNotNull()
    if high_quality:
        cond = cond & F.coalesce(F.col(high_quality), F.lit(True))
    return cond


def finite(c) -> Column:
    """Defined, not NaN, not +-infinity."""
    x = F.col(c) if isinstance(c, str) else c
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def select_phenos_for_clump(phenos: DataFrame, pop: str, mode: str, pops_col: str = "pops") -> DataFrame:
    """Phenotypes clumped for a population under one mode.

    single_pop: the population is among the phenotype's populations;
    not_pop: all 6-population phenotypes or 5-population ones lacking it;
    max_pops: every phenotype (clumped on its own population set).
    """
    arr = F.col(pops_col)
    if mode == "single_pop":
        return phenos.where(F.array_contains(arr, pop))
    if mode == "not_pop":
        return phenos.where((F.size(arr) == 6) | ((F.size(arr) == 5) & ~F.array_contains(arr, pop)))
    if mode == "max_pops":
        return phenos
    raise ValueError(mode)


def slice_modulo(df: DataFrame, order: Sequence[str], n_slices: int, slice_idx: int | None = None) -> DataFrame:
    """Work slicing: row index (0-based, total order) mod n."""
    from polyscore.operators.reshape import add_dim_index
    out = add_dim_index(df, order, "_i").withColumn("slice", (F.col("_i") % n_slices).cast("int")).drop("_i")
    return out if slice_idx is None else out.where(F.col("slice") == slice_idx)


def slice_contiguous(df: DataFrame, order: Sequence[str], n_slices: int, slice_idx: int | None = None) -> DataFrame:
    """Contiguous slices of ceil(n / k) rows in order, numbered from 1."""
    from polyscore.operators.reshape import add_dim_index
    n = df.count()
    size = max(1, -(-n // n_slices))
    out = add_dim_index(df, order, "_i").withColumn("slice", (F.floor(F.col("_i") / size) + 1).cast("int")).drop("_i")
    return out if slice_idx is None else out.where(F.col("slice") == slice_idx)
