"""Joins of the study expressed as equi-joins Catalyst can plan (no nested loops)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyscore.operators.deal import tasks_for


def interval_bin_join(points: DataFrame, intervals: DataFrame, *, chrom: str = "chrom", pos: str = "pos",
                      start: str = "start_pos", end: str = "end_pos", bin_size: int = 100_000,
                      end_inclusive: bool = False) -> DataFrame:
    """All (point, interval) pairs with start <= pos < end (or <= end) on the same contig.

    Intervals are exploded to the fixed-width bins they touch and joined to
    the point's bin: an equi-join on (chrom, bin) plus a residual range
    predicate, never a nested-loop or cartesian join.  Every point lies in
    exactly one bin, so each pair is produced once.
    """
    last = F.col(end) if end_inclusive else F.col(end) - 1
    iv = intervals.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(start) / bin_size).cast("long"),
                                                           F.floor(last / bin_size).cast("long"))))
    pt = points.withColumn("_bin", F.floor(F.col(pos) / bin_size).cast("long"))
    cond = (F.col(pos) >= F.col(start)) & ((F.col(pos) <= F.col(end)) if end_inclusive else (F.col(pos) < F.col(end)))
    return pt.join(iv.withColumnRenamed(chrom, "_ichrom"),
                   (pt[chrom] == F.col("_ichrom")) & (pt["_bin"] == iv["_bin"])).where(cond) \
        .drop("_ichrom", "_bin")


def genes_containing(variants: DataFrame, genes: DataFrame, *, key: str = "vid", as_string: bool = False,
                     out: str = "nearest_genes", **kw) -> DataFrame:
    """Per variant, the sorted names of gene intervals containing it (empty array if none)."""
    pairs = interval_bin_join(variants.select(key, "chrom", "pos"), genes, **kw)
    g = pairs.groupBy(key).agg(F.array_sort(F.collect_list("gene_name")).alias(out))
    res = variants.join(g, key, "left").withColumn(out, F.coalesce(F.col(out), F.array().cast("array<string>")))
    if as_string:
        res = res.withColumn(out, F.array_join(out, ","))
    return res


def unordered_allele_key(a: str, b: str):
    """Allele pair as a sorted array: joins match regardless of allele order."""
    return F.array_sort(F.array(F.col(a), F.col(b)))


def zip_join(tables: Sequence[DataFrame], keys: Sequence[str], value: str = "value", out: str = "values") -> DataFrame:
    """Multi-way outer zip join: one row per key with an N-array, null where a table lacks the key.

    All inputs are tagged with their position and unioned, then dealt by the
    key to as many tasks as their rows fill and grouped there: a single shuffle
    instead of N-1 pairwise outer joins.  A table with a key twice is refused.
    """
    n = len(tables)
    tagged = None
    for i, t in enumerate(tables):
        ti = t.select(*keys, F.lit(i).alias("_src"), F.col(value).alias("_v"))
        tagged = ti if tagged is None else tagged.unionByName(ti)
    tasks = tasks_for(tagged.sparkSession, tagged.count())
    of = [F.col("_src") == i for i in range(n)]
    g = tagged.repartition(tasks, *keys).groupBy(*keys).agg(
        *[F.first(F.when(s, F.col("_v")), ignorenulls=True).alias(f"_v{i}") for i, s in enumerate(of)],
        *[F.count(F.when(s, 1)).alias(f"_n{i}") for i, s in enumerate(of)])
    twice = F.array_max(F.array(*[F.col(f"_n{i}") for i in range(n)])) > 1
    values = F.array(*[F.col(f"_v{i}") for i in range(n)])
    return g.select(*keys, F.when(twice, F.raise_error(F.lit("zip_join: a table has a key twice"))).otherwise(values).alias(out))


def union_cols_inner(a: DataFrame, b: DataFrame, row_key: Sequence[str]) -> DataFrame:
    """Column union of two long matrices keeping only rows present in both (inner row join)."""
    ra = a.select(*row_key).distinct()
    rb = b.select(*row_key).distinct()
    shared = ra.join(rb, list(row_key), "inner")
    return a.join(shared, list(row_key), "left_semi").unionByName(b.join(shared, list(row_key), "left_semi"))
