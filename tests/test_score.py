"""Score routes: join + conditional sums, cumulative window, two-axis blocked product."""

import math

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as ent
from polyscore.operators import score as sc


def _rows(df):
    out = set()
    for r in df.collect():
        d = r.asDict()
        out.add((d["user_id"], d["pid"], d["p_threshold_name"], round(d["score"], 9)))
    return out


def test_three_routes_agree(spark, sf_small):
    q = ent.queries()
    a = _rows(q["prs_thresholds"](spark, sf_small))
    b = _rows(q["prs_cumulative"](spark, sf_small))
    c = _rows(q["prs_blocked"](spark, sf_small))
    assert len(a) > 1000 and a == b == c


def test_threshold_is_strict_and_nan_beta_skipped(spark):
    w = spark.createDataFrame([(1, 1, 2.0, 1e-2), (1, 2, float("nan"), 1e-9), (1, 3, 5.0, 1.0), (1, 4, 1.0, 1e-4)],
                              "pid long, vid long, beta double, p double")
    d = spark.createDataFrame([(10, 1, 1.0), (10, 2, 2.0), (10, 3, 2.0), (10, 4, 2.0)],
                              "user_id long, vid long, dosage double")
    got = {r.p_threshold_name: r.score for r in sc.threshold_scores(w, d, ["pid"]).collect()}
    # vid 4 (p=1e-4) counts from s4 (1e-3) on; vid 1 (p=1e-2) only from s6 (0.05): strict P < t
    assert "s3" not in got and got["s4"] == 2.0 and got["s5"] == 2.0 and got["s6"] == 4.0
    assert got["s10"] == 4.0  # P = 1 is outside even s10, NaN beta skipped
    assert all(not math.isnan(v) for v in got.values())


def test_weight_qc_counts(spark):
    w = spark.createDataFrame([(1, float("nan"), 0.1), (1, None, 0.2), (1, 1.0, None)], "pid long, beta double, p double")
    r = sc.weight_qc(w, ["pid"]).first()
    assert (r.n_weights, r.n_nan_beta, r.n_missing_beta, r.n_missing_p) == (3, 1, 1, 1)


def test_entry_smoke(spark):
    df = ent.entry(spark)
    assert df.count() > 0
    assert [f.name for f in df.schema.fields] == ["user_id", "pid", "p_threshold_name", "p_threshold", "score"]
    assert df.where(F.col("score").isNull()).count() == 0


@pytest.mark.parametrize("sizes,parts", [((64, 16, 3), 1), ((50, 1000, 10), 3), ((4096, 7, 100), 2)])
def test_blocks_and_parts_give_the_join_route(spark, sf_small, sizes, parts):
    import polyscore.operators.blocked as bl
    from polyscore.operators.reshape import add_dim_index
    from polyscore.sources.fixtures import Fixtures
    fx = Fixtures(spark, sf_small)
    v, s, c = sizes
    vix = add_dim_index(fx.variant.select("vid", "chrom", "pos"), ["chrom", "pos", "vid"], "vidx").select("vid", "vidx")
    six = add_dim_index(fx.sample.select("user_id"), ["user_id"], "sidx").select("user_id", "sidx")
    tiles = bl.genotype_tiles(fx.dosage, vix, six, variant_block=v, sample_block=s)
    want = _rows(sc.threshold_scores(fx.min_stat, fx.dosage, ["pid"]))
    got = _rows(bl.blocked_threshold_scores(fx.min_stat, tiles, vix, parts=parts, variant_block=v, sample_block=s, column_block=c))
    assert len(want) > 1000 and got == want


def test_tiles_of_parts_of_a_dosage(spark):
    import polyscore.operators.blocked as bl
    d = spark.createDataFrame([(1, 5, 0.25), (1, 6, 0.0), (2, 5, 1.75), (2, 6, None), (3, 6, 2.0)], "user_id long, vid long, dosage double")
    vix = spark.createDataFrame([(5, 0), (6, 1)], "vid long, vidx long")
    six = spark.createDataFrame([(1, 0), (2, 1), (3, 2)], "user_id long, sidx long")
    w = spark.createDataFrame([(9, 5, 2.0, 0.01), (9, 6, 3.0, 0.01)], "pid long, vid long, beta double, p double")
    tiles = bl.genotype_tiles(d, vix, six, scale=4, variant_block=2, sample_block=2)
    got = bl.blocked_threshold_scores(w, tiles, vix, scale=4, variant_block=2, sample_block=2, column_block=4)
    assert {(r.user_id, r.score) for r in got.collect()} == {(1, 0.5), (2, 3.5), (3, 6.0)}
    with pytest.raises(Exception, match="doesn't fit"):
        bl.genotype_tiles(d, vix, six, variant_block=2, sample_block=2).collect()


def test_no_tiles_and_no_weights(spark):
    import polyscore.operators.blocked as bl
    vix = spark.createDataFrame([(5, 0)], "vid long, vidx long")
    w = spark.createDataFrame([(9, 5, 2.0, 0.01)], "pid long, vid long, beta double, p double")
    tiles = spark.createDataFrame([], bl._TILE)
    assert bl.blocked_threshold_scores(w, tiles, vix).collect() == []
    tiles = spark.createDataFrame([(0, 0, bytes(8 * 2), bytes(4))], bl._TILE)
    sizes = {"variant_block": 2, "sample_block": 2, "column_block": 2}
    assert bl.blocked_threshold_scores(w.limit(0), tiles, vix, **sizes).collect() == []
