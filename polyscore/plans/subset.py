"""Ancestry-matched sample subsets and genotype subsets per population set."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from polyscore.constants import SUBSET_MAX_SAMPLES
from polyscore.operators.deal import tasks_for
from polyscore.sources.genotypes import write_ranges
from polyscore.operators.window import hash_order_key, top_n_per_group


def pop_proportions(samples: DataFrame, pop: str = "pop") -> DataFrame:
    """(pop, n, proportion of all samples)."""
    g = samples.groupBy(pop).agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("proportion", F.col("n") / F.sum("n").over(Window.partitionBy()))


def sample_sizes(samples: DataFrame, pop_sets: DataFrame, n_max: int = SUBSET_MAX_SAMPLES) -> DataFrame:
    """Subset size per population set: min(samples in the set, n_max).

    The study's rule int(min(n_pop / proportion, n_max)) is algebraically
    min(total, n_max); the integer form avoids float truncation.
    """
    members = pop_sets.select("pops", F.explode(F.split("pops", ",")).alias("pop"))
    counts = samples.groupBy("pop").agg(F.count(F.lit(1)).alias("n"))
    return (members.join(counts, "pop").groupBy("pops")
            .agg(F.least(F.sum("n"), F.lit(n_max)).alias("n_subset")))


def sample_subset(samples: DataFrame, pop_sets: DataFrame, n_max: int = SUBSET_MAX_SAMPLES, seed: int = 1) -> DataFrame:
    """Simple random subset of each population set: the n smallest hash keys of its samples.

    n = min(samples in the set, n_max); the whole set when it is small.
    ``row_number() <= n`` becomes a partial top-n before the shuffle, so
    a large population (e.g. a third of all samples) ships at most n rows
    per task.  Returns (pops, user_id, s, pop).
    """
    members = pop_sets.select("pops", F.explode(F.split("pops", ",")).alias("pop"))
    cand = samples.join(members, "pop").withColumn("_h", hash_order_key("s", seed))
    return top_n_per_group(cand, ["pops"], ["_h", "user_id"], n_max).drop("_h")


def genotype_subset(dosage: DataFrame, subset: DataFrame, variants: DataFrame) -> DataFrame:
    """Genotypes of the subset samples, with variant id and contig, per population set.

    Calls are dealt by sample and by variant to as many tasks as they fill; a call carries the
    sets of its sample (at most 63) and is repeated for them at the end.
    """
    from polyscore.functions import ids
    v = variants.select("vid", "chrom", ids.variant_id().alias("varid"))
    sets = subset.groupBy("user_id").agg(F.collect_list(F.struct("pops")).alias("_sets"))
    tasks = tasks_for(dosage.sparkSession, dosage.count())
    return (dosage.repartition(tasks, "user_id").join(sets, "user_id")
            .repartition(tasks, "vid").join(v, "vid")
            .withColumn("pops", F.explode("_sets.pops"))
            .select("pops", "chrom", "vid", "varid", "user_id", "dosage"))


def write_genotype_subset(df: DataFrame, path: str, **sizes: int) -> None:
    """Folders by population set and chromosome, each of as many files as its ranges of variants fill."""
    write_ranges(df, path, folders=("pops", "chrom"), pos="vid", **sizes)
