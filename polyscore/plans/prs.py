"""Polygenic score plans: weight preparation, scoring, blocked product, labels.

Weight preparation follows the study: meta-analysis columns (one per
population set) and single-population columns are unioned into one column
dimension keyed by (phenotype, clump_pops_str); duplicate columns keep the
meta-analysis; missing BETA / Pvalue are filled from the single-population
statistics independently; only cells that are clump index variants get a
weight, and columns without any clump result are dropped.  Thresholds
are applied inside the score aggregation (``operators.score``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from polyscore.operators import score as sc
from polyscore.operators.sinks import materialize
from polyscore.session import scratch_path


def stats_columns(meta: DataFrame, meta_data: DataFrame, sumstats: DataFrame) -> DataFrame:
    """Union of meta and single-population statistics, keyed by (pid, clump_pops_str, vid).

    ``source`` is 0 for meta-analysis, 1 for single population.
    """
    m = (meta.join(meta_data.select("pid", "meta_ix", "pops_str"), ["pid", "meta_ix"])
         .select("pid", F.col("pops_str").alias("clump_pops_str"), "vid", F.col("beta").alias("BETA"),
                 F.col("p").alias("Pvalue"), F.lit(0).alias("source")))
    s = sumstats.select("pid", F.col("pop").alias("clump_pops_str"), "vid", F.col("beta").alias("BETA"),
                        F.col("p").alias("Pvalue"), F.lit(1).alias("source"))
    return m.unionByName(s)


def column_dimension(meta_data: DataFrame, pheno_pop: DataFrame) -> DataFrame:
    """(pid, clump_pops_str, source) of every score column: meta sets (0) and single populations (1).

    Built from the dimension tables, so it is phenotype-sized, never a
    DISTINCT over the statistics.
    """
    return (meta_data.select("pid", F.col("pops_str").alias("clump_pops_str"), F.lit(0).alias("source"))
            .unionByName(pheno_pop.select("pid", F.col("pop").alias("clump_pops_str"), F.lit(1).alias("source"))))


def distinct_columns(cols: DataFrame, dim: DataFrame | None = None, key=("pid", "clump_pops_str"),
                     priority: str = "source") -> DataFrame:
    """One column per key: the highest-priority source (meta before single population).

    The choice is made on the column dimension (``dim``, phenotype-sized;
    derived from ``cols`` when not given) and semi-joined back to the entries.
    """
    if dim is None:
        dim = cols.select(*key, priority).distinct()
    return cols.join(_chosen(dim, key, priority), [*key, priority], "left_semi")


def _chosen(dim: DataFrame, key=("pid", "clump_pops_str"), priority: str = "source") -> DataFrame:
    w = Window.partitionBy(*key).orderBy(priority)
    return dim.select(*key, priority).withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def coalesce_from(stats: DataFrame, single: DataFrame, key=("pid", "clump_pops_str", "vid")) -> DataFrame:
    """Fill missing BETA and Pvalue, each independently, from the single-population statistics.

    Only rows with a hole are looked up: complete rows pass through, the
    fill source is first semi-joined to the keys of the rows with holes,
    so the statistics are never joined with themselves in full.
    """
    key = list(key)
    hole = F.col("BETA").isNull() | F.col("Pvalue").isNull()
    complete = stats.where(~hole)
    holes = stats.where(hole)
    fills = (single.select(*key, F.col("BETA").alias("_b"), F.col("Pvalue").alias("_p"))
             .join(holes.select(*key), key, "left_semi"))
    filled = (holes.join(fills, key, "left")
              .withColumn("BETA", F.coalesce("BETA", "_b"))
              .withColumn("Pvalue", F.coalesce("Pvalue", "_p"))
              .drop("_b", "_p"))
    return complete.unionByName(filled)


def prs_weights(meta: DataFrame, meta_data: DataFrame, sumstats: DataFrame, clump: DataFrame,
                pheno_pop: DataFrame | None = None) -> DataFrame:
    """Weights (pid, clump_pops_str, vid, beta, p) on clump index variants only.

    ``clump`` has (pid, vid, clump_pops_str, TOTAL, ...).  A weight exists
    where the clump defines TOTAL; the threshold indicator is applied later.
    With ``pheno_pop`` the column choice is made on the dimension tables, before
    the statistics get their columns: those of a column without clump results aren't shuffled to the clumps.
    """
    cols = stats_columns(meta, meta_data, sumstats)
    single = cols.where("source = 1")  # complete: the column choice drops the single-population twins of meta columns
    cl = clump.where(F.col("TOTAL").isNotNull()).select("pid", "vid", "clump_pops_str")
    if pheno_pop is None:
        kept = distinct_columns(cols)
    else:
        keep = (_chosen(column_dimension(meta_data, pheno_pop))
                .join(cl.select("pid", "clump_pops_str").distinct(), ["pid", "clump_pops_str"], "left_semi"))
        by = lambda source, name: keep.where(F.col("source") == source).select("pid", F.col("clump_pops_str").alias(name))
        kept = stats_columns(meta, meta_data.join(by(0, "pops_str"), ["pid", "pops_str"], "left_semi"),
                             sumstats.join(by(1, "pop"), ["pid", "pop"], "left_semi"))
    filled = coalesce_from(kept, single)
    return (filled.join(cl, ["pid", "vid", "clump_pops_str"])
            .select("pid", "clump_pops_str", "vid", F.col("BETA").alias("beta"), F.col("Pvalue").alias("p")))


def prs_scores(weights: DataFrame, dosage: DataFrame) -> DataFrame:
    """Thresholded scores per (user, pid, clump_pops_str, threshold).

    The population sets are few (at most 63): the products, the largest rows to be shuffled,
    carry a set's number, and the sums get its name. The weights are stored for that.
    """
    w = materialize(weights, scratch_path(weights.sparkSession, "weights"))
    names = sorted(r[0] for r in w.select("clump_pops_str").distinct().collect())
    if not names:
        return sc.threshold_scores(w, dosage, ["pid", "clump_pops_str"])
    sets = F.array(*[F.lit(name) for name in names])
    numbered = w.select("pid", F.array_position(sets, F.col("clump_pops_str")).cast("int").alias("_set"), "vid", "beta", "p")
    scores = sc.threshold_score_arrays(numbered, dosage, ["pid", "_set"])
    return (scores.select("user_id", "pid", F.get(sets, F.col("_set") - 1).alias("clump_pops_str"), F.inline("scores"))
            .where(F.col("score").isNotNull()))


def label_scores(scores: DataFrame, pheno: DataFrame) -> DataFrame:
    """Attach the five-field phenotype key (dimension join, phenotype-sized)."""
    return scores.join(pheno.select("pid", "trait_type", "phenocode", "pheno_sex", "coding", "modifier"), "pid")


def coalesce_qc(stats: DataFrame, key=("pid", "clump_pops_str")) -> DataFrame:
    """Per score column: rows whose BETA / Pvalue need filling, and rows where only one of the two does.

    BETA and Pvalue are filled independently, so a filled row can mix two
    sources; this count makes that visible.
    """
    b, p = F.col("BETA").isNull(), F.col("Pvalue").isNull()
    return stats.groupBy(*key).agg(
        F.count(F.when(b, 1)).alias("n_beta_filled"), F.count(F.when(p, 1)).alias("n_pvalue_filled"),
        F.count(F.when(b != p, 1)).alias("n_mixed_source"))
