from pyspark.sql import functions as F

from polyscore.operators.reshape import pheno_data_arrays, separate_by_pop, summary_stat_arrays
from polyscore.plans.sumstats import filter_low_confidence, filter_phenos_by_lambda

FIELDS = ["beta", "p", "low_confidence"]


def _frames(spark):
    pp = spark.createDataFrame([(1, "AFR", 1.0), (1, "EUR", 3.0), (1, "MID", 1.1), (2, "EUR", 0.3)],
                               "pid long, pop string, lambda_gc double")
    st = spark.createDataFrame([(1, 10, "AFR", 0.5, 1e-3, False), (1, 10, "EUR", 0.7, 1e-2, False),
                                (1, 11, "MID", 0.1, 0.2, True), (1, 12, "AFR", 0.2, 0.3, None),
                                (2, 10, "EUR", 1.0, 0.5, False)],
                               "pid long, vid long, pop string, beta double, p double, low_confidence boolean")
    cols = pheno_data_arrays(pp, fields=["lambda_gc"])
    return cols, summary_stat_arrays(st, cols, FIELDS)


def test_arrays_align_with_pheno_data(spark):
    cols, ent = _frames(spark)
    r = ent.where("pid = 1 AND vid = 10").first()
    assert [x.beta if x else None for x in r.summary_stats] == [0.5, 0.7, None]


def test_lambda_filter_drops_indices_and_empty_phenotypes(spark):
    cols, ent = _frames(spark)
    c, e = filter_phenos_by_lambda(cols, ent)
    assert [r.pid for r in c.collect()] == [1]
    r = e.where("vid = 10").first()
    assert [x.pop for x in c.first().pheno_data] == ["AFR", "MID"]
    assert [x.beta if x else None for x in r.summary_stats] == [0.5, None]


def test_low_confidence_nulls_and_drops(spark):
    cols, ent = _frames(spark)
    e = filter_low_confidence(ent.where("pid = 1"))
    vids = sorted(r.vid for r in e.collect())
    # vid 11 only had a low-confidence statistic, vid 12 an unknown one: both dropped
    assert vids == [10]


def test_separate_by_pop_picks_matching_element(spark):
    cols, ent = _frames(spark)
    out = separate_by_pop(cols, ent).where("pid = 1 AND vid = 10").select(
        F.col("pheno_data.pop").alias("pop"), F.col("summary_stats.beta").alias("beta")).collect()
    assert sorted((r.pop, r.beta) for r in out) == [("AFR", 0.5), ("EUR", 0.7), ("MID", None)]
