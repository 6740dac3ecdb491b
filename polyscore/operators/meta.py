"""Meta-analysis population sets and their statistics in long form.

The study stores meta-analyses as parallel arrays per phenotype: entry
``j = 0`` is the meta-analysis over all of the phenotype's populations,
``j = 1..6`` leave out population ``j - 1`` (only for 6-population
phenotypes).  Here each set is a row of a small column dimension
``(pid, meta_ix, pops)`` and the statistics a long fact table keyed by
``(pid, vid, meta_ix)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyscore.constants import POPS


def meta_sets(pheno_pop: DataFrame) -> DataFrame:
    """(pid, meta_ix, pops, pops_str): index 0 all pops (>1 pop), k = all but POPS[k-1] (6 pops)."""
    # one row per phenotype; the collected list is bounded by the 6 populations
    g = pheno_pop.groupBy("pid").agg(F.array_sort(F.collect_list("pop")).alias("pops"))
    everything = g.where(F.size("pops") > 1).select("pid", F.lit(0).alias("meta_ix"), "pops")
    loo = (g.where(F.size("pops") == len(POPS))
           .select("pid", "pops", F.posexplode(F.array(*[F.lit(p) for p in POPS])).alias("k", "left_out"))
           .select("pid", (F.col("k") + 1).alias("meta_ix"),
                   F.array_except("pops", F.array("left_out")).alias("pops")))
    return (everything.unionByName(loo)
            .withColumn("pops_str", F.array_join("pops", ",")))


def meta_members(meta_data: DataFrame) -> DataFrame:
    return meta_data.select("pid", "meta_ix", F.explode("pops").alias("pop"))


def meta_analysis(sumstats: DataFrame, meta_data: DataFrame, tasks: int) -> DataFrame:
    """Combine per-population statistics into one row per (pid, vid, meta_ix).

    The combination rule of the fixture is a deterministic stand-in for an
    inverse-variance meta-analysis: summed effect, smallest p-value,
    largest p-value as heterogeneity p, summed N.  A statistic is dealt once, with
    the sets that it belongs to, and repeated for these (at most 7) where they are summed.
    """
    members = meta_members(meta_data).groupBy("pid", "pop").agg(F.collect_list("meta_ix").alias("_sets"))
    return (sumstats.join(members, ["pid", "pop"]).drop("pop", "low_confidence")
            .repartition(tasks, "pid", "vid").withColumn("meta_ix", F.explode("_sets"))
            .groupBy("pid", "vid", "meta_ix")
            .agg(F.sum("beta").alias("beta"), F.min("se").alias("se"), F.min("p").alias("p"),
                 F.max("p").alias("p_het"), F.sum("n").alias("n"), F.max("af").alias("af"),
                 F.max("af_cases").alias("af_cases"), F.max("af_controls").alias("af_controls")))
