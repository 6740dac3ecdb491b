"""Steps whose size follows the rows that they make, not those that they read."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from polyscore.operators import blocked as bl
from polyscore.operators import ld
from polyscore.operators import score as sc
from polyscore.sources import fixtures as fx


@pytest.fixture
def study(spark):
    """30 samples with the same 4 variants, 20 columns with weights on each: 2,400 products."""
    dosage = spark.range(30).select(F.col("id").alias("user_id"), F.explode(F.expr("sequence(0L, 3L)")).alias("vid")) \
        .withColumn("dosage", ((F.col("user_id") + F.col("vid")) % 3).cast("double"))
    weights = spark.range(20).select(F.col("id").alias("pid"), F.explode(F.expr("sequence(0L, 3L)")).alias("vid")) \
        .withColumn("beta", (F.col("pid") - 7).cast("double")).withColumn("p", F.lit(0.3) / (1 + F.col("vid")))
    return weights, dosage


@pytest.mark.parametrize("of", [sc.score, sc.threshold_score_arrays, sc.cumulative_threshold_scores])
def test_products_are_dealt_before_they_are_summed(spark, study, monkeypatch, of):
    monkeypatch.setattr(sc, "PRODUCTS", 300)
    got = of(*study, ["pid"])
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "partial_sum" in plan[:plan.index("REPARTITION_BY_NUM")]
    assert "partial_sum" not in plan[plan.index("REPARTITION_BY_NUM"):]
    assert got.rdd.getNumPartitions() == 8
    assert got.select("user_id", "pid").distinct().count() == 600


def test_scores_at_thresholds_in_any_order(study):
    thresholds = [("b", 0.2), ("a", 0.08), ("c", 1.0)]
    rows = sc.threshold_scores(*study, ["pid"], thresholds=thresholds).collect()
    got = {(r.user_id, r.pid, r.p_threshold_name): r.score for r in rows}
    want = {(u, c, name): sum((c - 7) * ((u + v) % 3) for v in range(4) if 0.3 / (1 + v) < t)
            for u in range(30) for c in range(20) for name, t in thresholds}
    assert got == want


def test_phenotype_matrix_is_computed_by_blocks(spark, sf_small, monkeypatch):
    monkeypatch.setattr(fx, "MATRIX_ROWS", 40)
    monkeypatch.setattr(fx, "MATRIX_COLUMNS", 3)
    f = fx.Fixtures(spark, sf_small)
    n, m = f.sample.count(), f.pheno.count()
    got = f.phenotype
    assert got.rdd.getNumPartitions() == -(-(-(-n // 40) * -(-m // 3)) // fx.MATRIX_BLOCKS) > 1
    assert got.count() == n * m == got.select("user_id", "pid").distinct().count()
    assert "inputs/phenotype" not in got._jdf.queryExecution().toString()


def test_a_tile_with_few_calls_is_short_and_scores_the_same(spark, study):
    weights, dosage = study
    dosage = dosage.where("user_id % 5 = vid")  # few calls
    vix = spark.range(4).select(F.col("id").alias("vid"), F.col("id").alias("vidx"))
    six = spark.range(30).select(F.col("id").alias("user_id"), F.col("id").alias("sidx"))
    sizes = {"variant_block": 64, "sample_block": 64}
    tiles = bl.genotype_tiles(dosage, vix, six, **sizes)
    assert [len(r.cells) for r in tiles.collect()] == [5 * dosage.count()]
    key = lambda df: sorted((r.user_id, r.pid, r.p_threshold_name, r.score) for r in df.collect())
    assert key(bl.blocked_threshold_scores(weights, tiles, vix, column_block=16, **sizes)) == key(sc.threshold_scores(weights, dosage, ["pid"]))


def test_weights_come_in_pieces_and_only_to_blocks_with_calls(spark, study, monkeypatch):
    monkeypatch.setattr(bl, "WEIGHTS", 8)
    weights, dosage = study
    dosage = dosage.where("(user_id < 10) = (vid < 2)").where("user_id < 20")
    vix = spark.range(4).select(F.col("id").alias("vid"), F.col("id").alias("vidx"))
    six = spark.range(30).select(F.col("id").alias("user_id"), F.col("id").alias("sidx"))
    sizes = {"variant_block": 2, "sample_block": 10}
    tiles = bl.genotype_tiles(dosage, vix, six, **sizes)
    got = bl.blocked_threshold_scores(weights, tiles, vix, column_block=32, **sizes)
    key = lambda df: sorted((r.user_id, r.pid, r.p_threshold_name, r.score) for r in df.collect())
    assert key(got) == key(sc.threshold_scores(weights, dosage, ["pid"]))
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == bl.BATCH


def test_ld_planes_with_few_calls_are_lists(spark):
    calls = [(s, 1, 1.0 + s % 2) for s in range(0, 2000, 400)] + [(s, 2, 1.0) for s in range(2000)]
    dosage = spark.createDataFrame(calls, "user_id long, vid long, dosage double")
    panel = spark.range(2000).select(F.lit("all").alias("panel"), F.col("id").alias("user_id"))
    variants = spark.createDataFrame([(1, "1", 10), (2, "1", 20)], "vid long, chrom string, pos int")
    index = ld.sample_index(panel)
    rows = {r.vid: (len(r.one), len(r.two)) for r in ld.bit_planes(dosage, index, variants, 2000).collect()}
    assert rows == {1: (20, 0), 2: (2048 // 8, 0)}
    g = np.zeros((2, 2000))
    for s, v, x in calls:
        g[v - 1, s] = x
    g[1, 5:900] = 0
    half = dosage.where("not (vid = 2 and user_id between 5 and 899)")
    got = ld.panels_ld_pairs(half, panel, variants, r2_min=0.0).collect()
    assert [(r.vid_a, r.vid_b) for r in got] == [(1, 2)] and abs(got[0].r2 - np.corrcoef(g)[0, 1] ** 2) < 1e-12


@pytest.mark.parametrize("of", [sc.score, sc.threshold_score_arrays, sc.cumulative_threshold_scores])
def test_the_join_of_products_is_dealt_by_their_number(study, monkeypatch, of):
    monkeypatch.setattr(sc, "PRODUCTS", 300)
    plan = of(*study, ["pid"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression [vid") == 2 and ", 8" in plan[plan.index("RepartitionByExpression [vid"):]


def test_bucket_sums_run_on_without_a_window(study):
    weights, dosage = study
    got = sc.cumulative_threshold_scores(weights, dosage, ["pid"])
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()
    key = lambda df: sorted((r.user_id, r.pid, r.p_threshold_name, r.score) for r in df.collect())
    assert key(got) == key(sc.threshold_scores(weights, dosage, ["pid"]))


def test_products_carry_the_number_of_a_population_set(study):
    from polyscore.plans import prs
    weights, dosage = study
    weights = weights.withColumn("clump_pops_str", F.when(F.col("pid") % 2 == 0, "AFR,EUR").otherwise("MID"))
    got = prs.prs_scores(weights, dosage)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    dealt = plan[plan.index("RepartitionByExpression [user_id"):].splitlines()[0]
    assert "_set" in dealt and "clump_pops_str" not in dealt
    key = lambda df: sorted((r.user_id, r.pid, r.clump_pops_str, r.p_threshold_name, r.score) for r in df.collect())
    assert key(got) == key(sc.threshold_scores(weights, dosage, ["pid", "clump_pops_str"]))
