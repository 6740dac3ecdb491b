"""Many products: weights and dosages are shuffled in their stead; the sums are those of Spark's join."""

import random

import pytest
from pyspark.sql import functions as F

from polyscore.operators import factored as fa
from polyscore.operators import score as sc


@pytest.fixture
def small(monkeypatch):
    for name, value in {"HELD": 400, "TASK_PRODUCTS": 2000, "CALLS": 200, "PRODUCTS": 50, "PACKED": 150, "OUT": 17}.items():
        monkeypatch.setattr(fa, name, value)


def _rows(df):
    return sorted(str(tuple(round(x, 9) if isinstance(x, float) else x for x in r)) for r in df.collect())


@pytest.mark.parametrize("kind", ["long", "string"])
@pytest.mark.parametrize("of", [sc.score, sc.threshold_scores, sc.cumulative_threshold_scores])
def test_sums_on_the_grid_are_those_of_the_join(spark, monkeypatch, small, of, kind):
    r = random.Random(7)
    one = lambda *values: r.choice([None, *values])
    cast = lambda v: v if v is None or kind == "long" else str(v)
    w = spark.createDataFrame([(cast(one(*range(-20, 20))), one("AFR", "AFR,EUR"), cast(one(*range(50))), one(1.0, -2.0, 0.5, float("nan"), 1e-3),
                                one(float("nan"), 1e-9, 1e-5, 0.04, 0.3, 1.0, 5e-8)) for _ in range(900)],
                              f"pid {kind}, pops string, vid {kind}, beta double, p double")
    d = spark.createDataFrame([(cast(one(*range(80))), cast(one(*range(60))), one(0.0, 1.0, 2.0, 0.25)) for _ in range(900)],
                              f"user_id {kind}, vid {kind}, dosage double")
    keys = ["pid", "pops"]
    want = of(w, d, keys)
    monkeypatch.setattr(sc, "FACTORED", 0)
    got = of(w, d, keys)
    assert got.dtypes == want.dtypes and len(_rows(got)) > 1000 and _rows(got) == _rows(want)


def test_products_are_not_shuffled(spark, monkeypatch, small):
    dosage = spark.range(30).select(F.col("id").alias("user_id"), F.explode(F.expr("sequence(0L, 3L)")).alias("vid"), F.lit(2.0).alias("dosage"))
    weights = spark.range(20).select(F.col("id").alias("pid"), F.explode(F.expr("sequence(0L, 3L)")).alias("vid"), F.lit(3.0).alias("beta"))
    monkeypatch.setattr(sc, "FACTORED", 2399)
    got = sc.score(weights, dosage, ["pid"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1 and "cell" in plan[plan.index("Exchange"):].splitlines()[0] + plan
    assert {r.score for r in got.collect()} == {24.0} and got.count() == 600


def test_the_grid_bounds_weights_and_products_and_ships_few_rows():
    rows, cols = fa.grid(36_000_000, 60_000_000, 1_700_000_000, 6)
    assert 36_000_000 / cols <= fa.HELD and 1_700_000_000 / (rows * cols) <= fa.TASK_PRODUCTS
    assert rows * 36_000_000 + cols * 60_000_000 < 1_700_000_000 / 4
    assert fa.grid(0, 0, 0, 1) == (1, 1)


@pytest.mark.parametrize("values", [[3], [5, 5, 9, 300], [-2**63, 2**63 - 1, 0], [2**40, -1, 7], list(range(1000))])
def test_whole_numbers_of_a_cell_come_back(values):
    import pyarrow as pa
    cell = pa.py_buffer(fa._cell([pa.array(values, pa.int64()), pa.array([float(v % 5) for v in values]), pa.array([-0.0] * len(values))]))
    got = fa._columns(cell, [pa.int64(), pa.float64(), pa.float64()])
    assert got[0].to_pylist() == values and got[1].to_pylist() == [float(v % 5) for v in values] and str(got[2][0]) == "-0.0"


def test_staging_leaves_no_shuffle_files(spark, tmp_path):
    from polyscore.operators.sinks import materialize
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    held = env.size()
    got = materialize(spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 10).alias("k")).count(), str(tmp_path / "rows"))
    assert got.count() == 10 and spark.conf.get(key, None) == before and env.size() <= held + 1  # got.count() has one of its own
