"""Domain datasets derived from the driver tables.

The study's inputs (summary statistics, genotypes, samples, phenotypes,
gene intervals) are re-expressed as deterministic projections of the
TPC-H-like tables, so every query's work grows with the given data:

* ``variant``      from part      (vid, chrom, pos, ref, alt, high_quality)
* ``sample``       from customer  (user_id, s, pop, in_qc_list, withdrawn)
* ``dosage``       lineitem x orders, hard calls 0/1/2 per (user_id, vid)
* ``stat``         lineitem x orders x customer, per (pid, vid, pop)
* ``pheno``        from supplier  (pid + the five-field phenotype key)
* ``pheno_pop``    phenotype x population rows with n, lambda-GC, h2
* ``sumstats``     ``stat`` restricted to each phenotype's populations
* ``meta``         meta-analysis per (pid, vid, meta_ix): 0 = all pops, k = without pop k-1
* ``min_stat``     ``stat`` by (pid, vid): summed beta, minimum p
* ``gene``         from nation    (chrom, start_pos, end_pos, gene_name)
* ``phenotype``    sample x all phenotypes, ``both_sexes`` 0/1/null

The same definitions exist as DuckDB SQL in ``polyscore.queries.oracle``.
Betas are integer valued so that sums are exact in both engines.
"""

from __future__ import annotations

import os
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from polyscore.constants import POPS, TRAIT_TYPES
from polyscore.operators.deal import joins_in, tasks_for
from polyscore.operators.matrix import Blocks
from polyscore.sources.tables import read_table

# Input datasets of the study (stored tables in a real deployment): derived once per
# session and read back as parquet, unless POLYSCORE_STAGE_INPUTS=0.
STAGED_INPUTS = ["variant", "sample", "dosage", "stat", "pheno", "pheno_pop", "gene", "meta",
                 "meta_data", "min_stat", "clump"]

#: Rows that a line counts for as the meta-analysis is dealt: a statistic is repeated for its sets.
META_ROWS = 3

#: Samples and phenotypes of a block of the phenotype matrix, and blocks of a task (expected).
MATRIX_ROWS, MATRIX_COLUMNS, MATRIX_BLOCKS = 1024, 256, 4


def case_index(expr: str, values: list[str]) -> str:
    """SQL CASE mapping an integer expression to the value at that index."""
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {expr} {whens} END"


def p_denominator(expr: str) -> str:
    return (f"CASE {expr} WHEN 0 THEN 1e11 WHEN 1 THEN 1e9 WHEN 2 THEN 1e7 WHEN 3 THEN 1e6 "
            "WHEN 4 THEN 1e5 WHEN 5 THEN 1e4 ELSE 1e3 END")


def pops_array() -> Column:
    return F.array(*[F.lit(p) for p in POPS])


class Fixtures:
    """Lazily built fixture DataFrames over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, stage: bool | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.stage = os.environ.get("POLYSCORE_STAGE_INPUTS", "1") != "0" if stage is None else stage

    def __getattribute__(self, name):
        if name in STAGED_INPUTS and object.__getattribute__(self, "stage"):
            cache = object.__getattribute__(self, "__dict__")
            key = f"_staged_{name}"
            if key not in cache:
                cache[key] = self.staged(name)
            return cache[key]
        return object.__getattribute__(self, name)

    def derived(self, name: str) -> DataFrame:
        """The fixture computed from the driver tables, or from other inputs where these are staged."""
        return object.__getattribute__(Fixtures(self.spark, self.sf_dir, stage=self.stage), name)

    def staged(self, name: str) -> DataFrame:
        from polyscore.sources.staged import staged_path

        def build(path: str) -> None:
            rows = self.derived(name)  # stages the inputs that it is made of
            with joins_in(self.spark, self.tasks):
                rows.write.mode("overwrite").parquet(path)

        return self.spark.read.parquet(staged_path(self.spark, self.sf_dir, f"inputs/{name}", build))

    def of_samples(self, part: int, parts: int) -> Fixtures:
        """The same study with the samples, and their dosages, of one of ``parts`` by the hash of the sample."""
        other = Fixtures(self.spark, self.sf_dir, stage=self.stage)
        for name in ("sample", "dosage"):
            some = getattr(self, name).where(F.pmod(F.hash("user_id"), F.lit(parts)) == part)
            other.__dict__.update({name: some, f"_staged_{name}": some})
        return other

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    @cached_property
    def tasks(self) -> int:
        """Tasks of a step over all lines; their number is in the file's footer."""
        return tasks_for(self.spark, self.table("lineitem").count())

    @cached_property
    def variant(self) -> DataFrame:
        return self.table("part").selectExpr(
            "p_partkey AS vid",
            "CAST(1 + p_partkey % 22 AS STRING) AS chrom",
            "CAST(1000 + (p_partkey DIV 22) * 20000 AS INT) AS pos",
            "substr('ACGT', CAST(p_partkey % 4 AS INT) + 1, 1) AS ref",
            "substr('ACGT', CAST((p_partkey + 1 + (p_partkey DIV 4) % 3) % 4 AS INT) + 1, 1) AS alt",
            "p_size > 5 AS high_quality",
        )

    @cached_property
    def sample(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "c_custkey AS user_id",
            "CAST(c_custkey AS STRING) AS s",
            f"{case_index('c_nationkey % 6', POPS)} AS pop",
            "c_custkey % 10 <> 0 AS in_qc_list",
            "c_custkey % 37 = 0 AS withdrawn",
        )

    @cached_property
    def dosage(self) -> DataFrame:
        """Calls of each line's part, shared with the variant before it in blocks of four neighbours (LD)."""
        li = self.table("lineitem").selectExpr(
            "l_orderkey", "l_quantity",
            "explode(CASE WHEN (l_partkey DIV 22) % 4 <> 0 AND l_orderkey % 4 <> 0 "
            "THEN array(l_partkey, l_partkey - 22) ELSE array(l_partkey) END) AS vid")
        od = self.table("orders").select("o_orderkey", "o_custkey")
        lines = li.repartition(self.tasks, "l_orderkey").join(od, li.l_orderkey == od.o_orderkey)
        return (lines.select(F.col("o_custkey").alias("user_id"), "vid", (F.col("l_quantity").cast("int") % 3).alias("_call"))
                .repartition(self.tasks, "user_id", "vid").groupBy("user_id", "vid")
                .agg(F.max("_call").cast("double").alias("dosage")))

    @cached_property
    def stat(self) -> DataFrame:
        li = self.table("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_discount")
        od = self.table("orders").select("o_orderkey", "o_custkey")
        cu = self.table("customer").select("c_custkey", "c_nationkey")
        people = od.join(cu, od.o_custkey == cu.c_custkey).select(
            "o_orderkey", F.expr(case_index("c_nationkey % 6", POPS)).alias("pop"))
        lines = li.repartition(self.tasks, "l_orderkey").join(people, li.l_orderkey == people.o_orderkey).select(
            F.col("l_suppkey").alias("pid"), F.col("l_partkey").alias("vid"), "pop",
            F.expr("CAST(round(l_discount * 100) AS BIGINT) - 5").alias("_beta"),
            F.expr("(1 + (l_orderkey * 7919 + l_partkey * 104729) % 999) / "
                   + p_denominator("(l_orderkey + l_suppkey) % 9")).alias("_p"))
        g = (lines.repartition(self.tasks, "pid", "vid").groupBy("pid", "vid", "pop")
             .agg(F.sum("_beta").alias("beta_c"), F.count(F.lit(1)).alias("n"), F.min("_p").alias("p")))
        return g.selectExpr(
            "pid", "vid", "pop",
            "CAST(beta_c AS DOUBLE) AS beta",
            "(10 + n) / 1e1 AS se",
            "p", "n",
            "(1 + (vid * 31 + pid * 7) % 98) / 1e2 AS af",
            "(1 + (vid * 17 + pid * 3) % 98) / 1e2 AS af_cases",
            "(1 + (vid * 13 + pid * 11) % 98) / 1e2 AS af_controls",
            "CASE WHEN (pid + vid) % 17 = 0 THEN NULL ELSE (pid + vid) % 13 = 0 END AS low_confidence",
        )

    @cached_property
    def pheno(self) -> DataFrame:
        return self.table("supplier").selectExpr(
            "s_suppkey AS pid",
            f"{case_index('s_suppkey % 6', TRAIT_TYPES)} AS trait_type",
            "CAST(20000 + s_suppkey AS STRING) AS phenocode",
            "'both_sexes' AS pheno_sex",
            "CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE 'c ' || CAST(s_nationkey AS STRING) || '/x' END AS coding",
            "CASE WHEN s_suppkey % 6 = 0 THEN 'irnt' ELSE '' END AS modifier",
        )

    @cached_property
    def pheno_pop(self) -> DataFrame:
        # phenotype x the 6-row constant population list, as a generator (no join)
        pops = F.explode(F.arrays_zip(F.sequence(F.lit(0), F.lit(len(POPS) - 1)).alias("pop_ix"),
                                      pops_array().alias("pop")))
        return (self.pheno.select("pid", pops.alias("pp"))
                .select("pid", F.col("pp.pop").alias("pop"), F.col("pp.pop_ix").alias("pop_ix"))
                .where("pid % 4 = 0 OR 4 * pop_ix + 1 = pid % 24 OR (pid % 4 > 1 AND (pid + pop_ix) % 6 <> 0)")
                .selectExpr("pid", "pop", "pop_ix",
                            "50 + (pid * 13 + pop_ix * 7) % 500 AS n_cases",
                            "1000 + (pid * 29 + pop_ix * 3) % 9000 AS n_controls",
                            "((pid * 7 + pop_ix * 11) % 17 + 4) / 1e1 AS lambda_gc",
                            "((pid * 3 + pop_ix * 5) % 50) / 1e2 AS heritability"))

    @cached_property
    def num_pops(self) -> DataFrame:
        return self.pheno_pop.groupBy("pid").agg(F.count(F.lit(1)).alias("num_pops"))

    @cached_property
    def sumstats(self) -> DataFrame:
        """Statistics of each phenotype's own populations only."""
        return self.stat.join(self.pheno_pop.select("pid", "pop"), ["pid", "pop"], "left_semi")

    @cached_property
    def min_stat(self) -> DataFrame:
        return self.stat.select("pid", "vid", "beta", "p").repartition(self.tasks, "pid", "vid").groupBy("pid", "vid").agg(F.sum("beta").alias("beta"), F.min("p").alias("p"))

    @cached_property
    def meta_data(self) -> DataFrame:
        """Column dimension of the meta-analysis: (pid, meta_ix, pops)."""
        from polyscore.operators.meta import meta_sets
        return meta_sets(self.pheno_pop)

    @cached_property
    def meta(self) -> DataFrame:
        from polyscore.operators.meta import meta_analysis
        return meta_analysis(self.sumstats, self.meta_data, tasks_for(self.spark, META_ROWS * self.table("lineitem").count()))

    @cached_property
    def own_pops(self) -> DataFrame:
        """(pid, own_pops_str): the phenotype's populations, sorted, comma-joined."""
        return self.pheno_pop.groupBy("pid").agg(
            F.array_join(F.array_sort(F.collect_list("pop")), ",").alias("own_pops_str"))

    @cached_property
    def clump(self) -> DataFrame:
        """Clump results on each phenotype's own population set: index variants with their tallies."""
        return (self.min_stat.join(self.own_pops, "pid")
                .selectExpr("pid", "vid", "own_pops_str AS clump_pops_str", "p AS P",
                            "CAST(vid % 5 AS INT) AS NSIG", "CAST((vid + pid) % 4 AS INT) AS S05",
                            "CAST(pid % 3 AS INT) AS S01", "CAST(vid % 2 AS INT) AS S001",
                            "CAST((vid * pid) % 3 AS INT) AS S0001")
                .selectExpr("*", "NSIG + S05 + S01 + S001 + S0001 AS TOTAL"))

    @cached_property
    def gene(self) -> DataFrame:
        return self.table("nation").selectExpr(
            "CAST(1 + n_nationkey % 22 AS STRING) AS chrom",
            "CAST((n_nationkey * 37 % 90) * 20000 AS INT) AS start_pos",
            "CAST((n_nationkey * 37 % 90) * 20000 + 100000 AS INT) AS end_pos",
            "'G' || CAST(n_nationkey AS STRING) AS gene_name",
        )

    @cached_property
    def h2(self) -> DataFrame:
        """Heritability z-scores keyed by phenocode."""
        return self.pheno.selectExpr("phenocode AS phenotype", "((pid * 7) % 50) / 1e1 AS h2_z")

    @cached_property
    def blocks(self) -> Blocks:
        """The blocks of the phenotype matrix; the tasks follow the number of cells."""
        sides = ((self.sample, MATRIX_ROWS), (self.pheno.where("pid IS NOT NULL"), MATRIX_COLUMNS))
        rows, cols = (max(1, -(-df.count() // size)) for df, size in sides)
        return Blocks(rows, cols, max(1, -(-rows * cols // MATRIX_BLOCKS)))

    @cached_property
    def phenotype_blocks(self) -> DataFrame:
        """``phenotype`` dealt by its ``block``."""
        people, phenos = self.sample.select("user_id"), self.pheno.where("pid IS NOT NULL")
        return (self.blocks.of_samples(people).join(self.blocks.of_phenos(phenos), "block")
                .selectExpr("block", "user_id", "pid", "trait_type", "phenocode", "pheno_sex", "coding", "modifier",
                            "CASE WHEN (user_id + pid) % 11 = 0 THEN NULL "
                            "WHEN (user_id * 31 + pid * 17) % 5 = 0 THEN 1 ELSE 0 END AS both_sexes"))

    @cached_property
    def phenotype(self) -> DataFrame:
        """Phenotype values of every sample for every phenotype, computed where they are read.

        A matrix of blocks of samples and of phenotypes, a join by block. Its rows outnumber those of both
        sides by far, so the tasks follow the number of cells, and the matrix isn't stored.
        """
        return self.phenotype_blocks.drop("block")
