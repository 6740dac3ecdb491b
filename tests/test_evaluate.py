"""Statistics from sparse moments against numpy over the dense assessment table."""

import numpy as np
import pytest

from polyscore.plans import evaluate as ev

THRESHOLDS = [("a", 0.1), ("b", 1.0)]


@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(3)
    users = range(60)
    samples = spark.createDataFrame([(u, "EUR" if u % 3 else "AFR") for u in users], "user_id long, pop string")
    phenotype = spark.createDataFrame(
        [(u, p, None if (u + p) % 7 == 0 else (float(u % 4 == 0) if p < 2 else float(rng.normal(3))))
         for u in users for p in range(4)], "user_id long, pid long, both_sexes double")
    # phenotype 3 has a column without any score, so its score never varies
    columns = spark.createDataFrame([(p, "AFR,EUR") for p in range(4)], "pid long, clump_pops_str string")
    scores = spark.createDataFrame(
        [(u, p, "AFR,EUR", n, t, float(rng.normal(1))) for u in users for p in range(3) for n, t in THRESHOLDS
         if (u * 5 + p) % 4], "user_id long, pid long, clump_pops_str string, p_threshold_name string, "
                              "p_threshold double, score double")
    return scores, phenotype, columns, samples


@pytest.fixture(scope="module")
def dense(tables):
    return ev.assessment_table(*tables, thresholds=THRESHOLDS).toPandas()


@pytest.fixture(scope="module")
def moments(tables):
    return ev.score_moments(*tables, thresholds=THRESHOLDS)


def by_key(df):
    return {(r["pid"], r["p_threshold"], r.asDict().get("pop")): r for r in df.collect()}


def test_correlation_and_regression(dense, moments):
    corr, line = by_key(ev.score_corr(moments)), by_key(ev.score_regression(moments))
    assert len(corr) == 4 * 2 * 3 and len(line) == 4 * 2 * 2
    for (pid, t, pop), r in corr.items():
        d = dense[(dense.pid == pid) & (dense.p_threshold == t) & ((dense["pop"] == pop) | (pop == "all"))]
        assert r["n"] == len(d)
        if d.score.var() == 0:
            assert r["prs_corr_r"] is None
        else:
            assert r["prs_corr_r"] == pytest.approx(np.corrcoef(d.y, d.score)[0, 1], abs=2e-9)
        if pop != "all":
            slope, intercept = np.polyfit(d.y, d.score, 1)
            assert line[pid, t, pop]["slope"] == pytest.approx(slope, abs=2e-9)
            assert line[pid, t, pop]["intercept"] == pytest.approx(intercept, abs=2e-9)


def test_t_statistic(dense, moments):
    for (pid, t, pop), r in by_key(ev.case_control_ttest(moments)).items():
        d = dense[(dense.pid == pid) & (dense.p_threshold == t) & (dense["pop"] == pop)]
        a, b = d[d.y == 0].score, d[d.y == 1].score
        assert (r["n_controls"], r["n_cases"]) == (len(a), len(b))
        if min(len(a), len(b)) < 2 or d.score.var() == 0:
            assert r["t"] is None
            continue
        pooled = ((len(a) - 1) * a.var() + (len(b) - 1) * b.var()) / (len(a) + len(b) - 2)
        expected = (a.mean() - b.mean()) / np.sqrt(pooled * (1 / len(a) + 1 / len(b)))
        assert r["t"] == pytest.approx(expected, abs=2e-6)


def test_score_arrays_give_the_same_moments(spark, tables, moments):
    from pyspark.sql import functions as F
    scores, *rest = tables
    arrays = scores.groupBy("user_id", "pid", "clump_pops_str").agg(
        F.collect_list(F.struct("p_threshold_name", "p_threshold", "score")).alias("scores"))
    other = by_key(ev.score_moments(arrays, *rest, thresholds=THRESHOLDS))
    for key, r in by_key(moments).items():
        assert other[key]["n"] == r["n"] and other[key]["sy"] == pytest.approx(r["sy"])


def test_share_of_small_pvalues(spark, tables, moments):
    phenos = spark.createDataFrame([(p, str(p)) for p in range(4)], "pid long, phenocode string")
    h2 = spark.createDataFrame([(str(p), 5.0 if p != 1 else 0.0) for p in range(4)], "phenotype string, h2_z double")
    corr = ev.score_corr(moments).replace({"AFR,EUR": "EUR"}, subset=["clump_pops_str"])
    rows = ev.holdout_pvalues(corr, phenos, h2, pop="AFR", cutoff=1.0).collect()
    # phenotype 1 isn't heritable and phenotype 3 has no correlation
    assert [(r["n"], r["share_below"]) for r in rows] == [(2, 1.0)] * 2
    assert not ev.holdout_pvalues(corr, phenos, h2, pop="EUR").collect()


def test_cells_of_the_matrix_are_joined_where_they_are_made(spark, sf_small, monkeypatch):
    from pyspark.sql import functions as F

    from polyscore.operators.matrix import join_by_block
    from polyscore.operators.score import threshold_score_lists, threshold_scores
    from polyscore.sources import fixtures as fx
    monkeypatch.setattr(fx, "MATRIX_ROWS", 40)
    monkeypatch.setattr(fx, "MATRIX_COLUMNS", 3)
    f = fx.Fixtures(spark, sf_small)
    w = f.min_stat.withColumn("clump_pops_str", F.lit("EUR"))
    columns, keys = w.select("pid", "clump_pops_str"), ["pid", "clump_pops_str"]
    samples = f.sample.unionByName(f.sample.where("user_id < 4"))  # some come twice
    plain = threshold_scores(w, f.dosage, keys), f.phenotype, columns, samples
    join_by_block(spark)
    blocked = threshold_score_lists(w, f.dosage, keys, f.blocks), f.phenotype_blocks, columns, samples
    for of in (ev.score_moments, ev.assessment_table):
        got = of(*blocked, blocks=f.blocks)
        names = sorted(c for c in got.columns if c != "p_threshold_name")
        key = lambda df: sorted((str(r) for r in df.select(*names).collect()))  # noqa: E731, B023
        assert key(got) == key(of(*plain))
    moved = blocked[1].join(blocked[0].hint("shuffle_hash"), ["block", "user_id", "pid"])
    plan = moved._jdf.queryExecution().executedPlan().toString()
    assert "ENSURE_REQUIREMENTS" not in plan[:plan.index("REPARTITION_BY_NUM")]
