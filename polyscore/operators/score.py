"""Polygenic scores as a distributed join-and-aggregate.

The study multiplies a dense genotype matrix (variants x samples) by a
dense weights matrix (variants x score columns).  Both matrices are
sparse in the long form used here: a weight row exists only where a
variant is a clump index with a defined effect, and genotype entries are
stored only where present.  A score is therefore

    score(user, column) = sum over shared variants of beta * dosage

which Spark plans as an equi-join on the variant key followed by a
hash aggregation.  A sample and a column rarely meet twice in one task of
the join, so sums before the shuffle would save no rows and hold a map of all
of them: the products themselves are dealt to the tasks that sum them, whose
number follows from the exact number of products.  More than ``FACTORED`` of them
aren't shuffled at all: weights and dosages meet on a grid of tasks that form
the products and sum them (``operators.factored``).  P-value thresholds are
nested (P < t grows with t), so a product carries the rank of its p-value
among them and all ten scores of a column are ten conditional sums in the same
aggregation: one join, one shuffle, no 10x explode of the weights.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polyscore.constants import P_THRESHOLDS
from polyscore.operators.factored import factored_sums
from polyscore.operators.matrix import Blocks

#: Products of a weight and a dosage that a task sums (expected).
PRODUCTS = 2_000_000

#: Products from which on weights and dosages are shuffled in their stead.
FACTORED = 20_000_000


def usable_weights(weights: DataFrame, beta: str = "beta", p: str | None = "p",
                   max_threshold: float | None = None) -> DataFrame:
    """Drop weights that cannot contribute: beta missing or NaN, P missing/NaN, or P >= max threshold.

    NaN betas are dropped rather than multiplied (NaN x 0 would poison the
    whole score column); ``weight_qc`` counts them.
    """
    cond = F.col(beta).isNotNull() & ~F.isnan(beta)
    if p is not None:
        cond = cond & F.col(p).isNotNull() & ~F.isnan(p)
        if max_threshold is not None:
            cond = cond & (F.col(p) < F.lit(max_threshold))
    return weights.where(cond)


def weight_qc(weights: DataFrame, keys: Sequence[str], beta: str = "beta", p: str = "p") -> DataFrame:
    """Per score column: weight rows, NaN betas, missing betas, missing or NaN p-values."""
    return weights.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_weights"),
        F.count(F.when(F.isnan(beta), 1)).alias("n_nan_beta"),
        F.count(F.when(F.col(beta).isNull(), 1)).alias("n_missing_beta"),
        F.count(F.when(F.col(p).isNull() | F.isnan(p), 1)).alias("n_missing_p"),
    )


def _sizes(d: DataFrame, w: DataFrame, variant: str) -> tuple[int, int, int]:
    """Numbers of weights, of dosages and of their pairs with a shared variant, from the counts per variant of either side."""
    of = lambda df, name: df.where(F.col(variant).isNotNull()).groupBy(variant).agg(F.count(F.lit(1)).alias(name))
    found = of(d, "_d").join(of(w, "_w"), variant, "full").agg(F.sum("_w"), F.sum("_d"), F.sum(F.col("_d") * F.col("_w"))).first()
    return tuple(n or 0 for n in found)


def product_count(weights: DataFrame, dosage: DataFrame, *, variant: str = "vid", beta: str = "beta", p: str = "p",
                  dosage_col: str = "dosage", max_threshold: float | None = None) -> int:
    """Products of the usable weights and the dosages: what thresholded scores are summed from."""
    return _sizes(dosage.where(F.col(dosage_col).isNotNull()), usable_weights(weights, beta, p, max_threshold), variant)[2]


def _products(d: DataFrame, w: DataFrame, variant: str, by: Sequence[str], *values: Column, pairs: int, blocks: Blocks | None = None,
              stored_by_variant: bool = False) -> DataFrame:
    """Rows (*by, *values) of the ``pairs`` with a shared variant, dealt by ``by`` to as many tasks as the pairs need.

    The join is dealt to as
    many tasks, as it writes all pairs: a task that makes too many spills them before it writes them.
    It keeps the layout of dosages that are ``stored_by_variant``. With ``blocks``
    the rows get their ``block`` and are dealt by it, as the matrix that they are joined with.
    """
    tasks = max(1, -(-pairs // PRODUCTS))
    if tasks > 1 and not stored_by_variant:
        d, w = d.repartition(tasks, variant), w.repartition(tasks, variant)
    found = d.join(w, variant).select(*by, *values)
    return blocks.of_cells(found) if blocks is not None else found.repartition(tasks, *by)


def _factored(d: DataFrame, w: DataFrame, variant: str, sample: str, keys: Sequence[str], beta: str, dosage_col: str,
              sizes: tuple[int, int, int], out: Sequence[str], bucket: str | None = None, nested: bool = True) -> DataFrame | None:
    """The sums by ``factored_sums`` where the products are many, of doubles; None leaves them to Spark's join."""
    if sizes[2] <= FACTORED or dict(w.dtypes)[beta] != "double" or dict(d.dtypes)[dosage_col] != "double":
        return None
    present = F.col(variant).isNotNull()
    return factored_sums(w.where(present), d.where(present), variant=variant, sample=sample, keys=keys, beta=beta, dosage=dosage_col,
                         sizes=sizes, out=out, bucket=bucket, nested=nested)


def score(weights: DataFrame, dosage: DataFrame, keys: Sequence[str], *, variant: str = "vid",
          sample: str = "user_id", beta: str = "beta", dosage_col: str = "dosage",
          out: str = "score") -> DataFrame:
    """score(sample, keys) = sum(beta * dosage) over the variants both sides share.

    Missing dosages are skipped (they are simply absent rows).
    """
    w = usable_weights(weights, beta=beta, p=None).select(variant, *keys, beta)
    d = dosage.select(sample, variant, dosage_col).where(F.col(dosage_col).isNotNull())
    sizes = _sizes(d, w, variant)
    found = _factored(d, w, variant, sample, keys, beta, dosage_col, sizes, [out])
    if found is not None:
        return found
    return (_products(d, w, variant, [sample, *keys], (F.col(beta) * F.col(dosage_col)).alias("_x"), pairs=sizes[2])
            .groupBy(sample, *keys).agg(F.sum("_x").alias(out)))


def threshold_scores(weights: DataFrame, dosage: DataFrame, keys: Sequence[str], *,
                     thresholds: Sequence[tuple[str, float]] = P_THRESHOLDS, variant: str = "vid",
                     sample: str = "user_id", beta: str = "beta", p: str = "p",
                     dosage_col: str = "dosage", stored_by_variant: bool = False) -> DataFrame:
    """Scores at every p-value threshold: weight = beta * (P < t), strict.

    Output is sparse: one row per (sample, keys, threshold) that has at
    least one contributing variant.  P = 1 lies outside even the largest
    threshold.  The result has columns
    ``sample, *keys, p_threshold_name, p_threshold, score``.
    """
    g = threshold_score_arrays(weights, dosage, keys, thresholds=thresholds, variant=variant, sample=sample,
                               beta=beta, p=p, dosage_col=dosage_col, stored_by_variant=stored_by_variant)
    return g.select(sample, *keys, F.inline("scores")).where(F.col("score").isNotNull())


def threshold_score_arrays(weights: DataFrame, dosage: DataFrame, keys: Sequence[str], *,
                           thresholds: Sequence[tuple[str, float]] = P_THRESHOLDS, variant: str = "vid",
                           sample: str = "user_id", beta: str = "beta", p: str = "p",
                           dosage_col: str = "dosage", stored_by_variant: bool = False) -> DataFrame:
    """``threshold_scores`` before its thresholds become rows: (sample, *keys, scores[]), null where nothing contributes."""
    g = _threshold_sums(weights, dosage, keys, thresholds, variant, sample, beta, p, dosage_col, stored_by_variant=stored_by_variant)
    per_t = F.array(*[F.struct(F.lit(n).alias("p_threshold_name"), F.lit(float(t)).alias("p_threshold"),
                               F.col(f"_s{i}").alias("score"))
                      for i, (n, t) in enumerate(thresholds)])
    return g.select(sample, *keys, per_t.alias("scores"))


def threshold_score_lists(weights: DataFrame, dosage: DataFrame, keys: Sequence[str], blocks: Blocks, *,
                          thresholds: Sequence[tuple[str, float]] = P_THRESHOLDS, variant: str = "vid",
                          sample: str = "user_id", beta: str = "beta", p: str = "p", dosage_col: str = "dosage") -> DataFrame:
    """Scores dealt by ``block``: (block, sample, *keys, by_threshold[]), a bare score for each of ``thresholds`` or null."""
    g = _threshold_sums(weights, dosage, keys, thresholds, variant, sample, beta, p, dosage_col, blocks)
    return g.select("block", sample, *keys, F.array(*[f"_s{i}" for i in range(len(thresholds))]).alias("by_threshold"))


def _threshold_sums(weights, dosage, keys, thresholds, variant, sample, beta, p, dosage_col, blocks: Blocks | None = None,
                    stored_by_variant: bool = False) -> DataFrame:
    """A row per (sample, *keys) with its score at threshold i as ``_s<i>``."""
    max_t = max(t for _, t in thresholds)
    ranks = sorted({t for _, t in thresholds})
    w = (usable_weights(weights, beta=beta, p=p, max_threshold=max_t)
         .select(variant, *keys, beta, threshold_bucket(F.col(p), [("", t) for t in ranks]).alias("_b")))
    d = dosage.select(sample, variant, dosage_col).where(F.col(dosage_col).isNotNull())
    sizes = _sizes(d, w, variant)
    if blocks is None and not stored_by_variant:
        found = _factored(d, w, variant, sample, keys, beta, dosage_col, sizes, [f"_r{i}" for i in range(len(ranks))], "_b")
        if found is not None:
            return found.select(sample, *keys, *[F.col(f"_r{ranks.index(t)}").alias(f"_s{i}") for i, (_, t) in enumerate(thresholds)])
    dealt = _products(d, w, variant, [sample, *keys], F.col("_b"), (F.col(beta) * F.col(dosage_col)).alias("_x"), pairs=sizes[2],
                      blocks=blocks, stored_by_variant=stored_by_variant)
    sums = [F.sum(F.when(F.col("_b") <= ranks.index(t), F.col("_x"))).alias(f"_s{i}") for i, (_, t) in enumerate(thresholds)]
    return dealt.groupBy(*(["block"] if blocks is not None else []), sample, *keys).agg(*sums)


def threshold_bucket(p: Column, thresholds: Sequence[tuple[str, float]] = P_THRESHOLDS) -> Column:
    """Index of the smallest threshold t with p < t (null if none)."""
    expr = None
    for i, (_, t) in reversed(list(enumerate(thresholds))):
        expr = F.when(p < F.lit(t), F.lit(i)) if expr is None else F.when(p < F.lit(t), F.lit(i)).otherwise(expr)
    return expr


def cumulative_threshold_scores(weights: DataFrame, dosage: DataFrame, keys: Sequence[str], *,
                                thresholds: Sequence[tuple[str, float]] = P_THRESHOLDS,
                                variant: str = "vid", sample: str = "user_id", beta: str = "beta",
                                p: str = "p", dosage_col: str = "dosage") -> DataFrame:
    """Same result as ``threshold_scores`` by bucket sums and running sums over them.

    Each weight is assigned to its smallest threshold bucket; a row per (sample, keys)
    has the sum of each bucket, and its running sums in threshold order are the scores.
    A score exists from the first bucket on that at least one variant reaches.
    """
    max_t = max(t for _, t in thresholds)
    w = (usable_weights(weights, beta=beta, p=p, max_threshold=max_t)
         .select(variant, *keys, beta, threshold_bucket(F.col(p), thresholds).alias("_b")))
    d = dosage.select(sample, variant, dosage_col).where(F.col(dosage_col).isNotNull())
    sizes, sums = _sizes(d, w, variant), [f"_s{i}" for i in range(len(thresholds))]
    run = _factored(d, w, variant, sample, keys, beta, dosage_col, sizes, sums, "_b", nested=False)
    if run is None:
        run = (_products(d, w, variant, [sample, *keys], F.col("_b"), (F.col(beta) * F.col(dosage_col)).alias("_x"), pairs=sizes[2])
               .groupBy(sample, *keys).agg(*[F.sum(F.when(F.col("_b") == i, F.col("_x"))).alias(s) for i, s in enumerate(sums)]))
    for i in range(1, len(thresholds)):
        run = run.withColumn(f"_s{i}", F.coalesce(F.col(f"_s{i - 1}") + F.col(f"_s{i}"), f"_s{i - 1}", f"_s{i}"))
    per_t = F.array(*[F.struct(F.lit(n).alias("p_threshold_name"), F.lit(float(t)).alias("p_threshold"), F.col(f"_s{i}").alias("score"))
                      for i, (n, t) in enumerate(thresholds)])
    return run.select(sample, *keys, F.inline(per_t)).where(F.col("score").isNotNull())
