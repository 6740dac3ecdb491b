import math

from pyspark.sql import functions as F

from polyscore.functions import formatting as fmt
from polyscore.functions import ids
from polyscore.functions.arrays import index_of, kept_indices, set_equals, take_indices
from polyscore.operators.filters import lambda_gc_ok, min_allele_count


def test_pheno_id_optional_parts_and_cleaning(spark):
    df = spark.createDataFrame([("categorical", "20001", "both_sexes", "c 1/x", ""),
                                ("continuous", "50", "both_sexes", "", "irnt"),
                                ("icd10", "E11", "females", "", "")],
                               "trait_type string, phenocode string, pheno_sex string, coding string, modifier string")
    got = [r[0] for r in df.select(ids.pheno_id()).collect()]
    assert got == ["categorical-20001-both_sexes-c_1_x", "continuous-50-both_sexes-irnt", "icd10-E11-females"]


def test_variant_id_roundtrip(spark):
    df = spark.createDataFrame([("1", 1000, "A", "G")], "chrom string, pos int, ref string, alt string")
    r = df.select(ids.variant_id().alias("v")).select(*ids.split_variant_id("v"),
                                                      F.array_join(ids.alleles_of("v"), "/").alias("a")).first()
    assert (r.chrom, r.pos, r.ref, r.alt, r.a) == ("1", 1000, "A", "G", "A/G")


def test_format_stat_null_nan_and_bool(spark):
    df = spark.createDataFrame([(None, None), (float("nan"), True), (1.2e-5, False), (-12.0, None)],
                               "x double, b boolean")
    got = [(r[0], r[1]) for r in df.select(fmt.format_stat("x"), fmt.format_bool("b")).collect()]
    assert got == [(None, None), ("NaN", "true"), ("1.200e-05", "false"), ("-1.200e+01", None)]


def test_index_of_is_zero_based_and_null_when_absent(spark):
    df = spark.createDataFrame([(["AFR", "EUR"],)], "a array<string>")
    r = df.select(index_of("a", F.lit("EUR")).alias("i"), index_of("a", F.lit("MID")).alias("j")).first()
    assert r.i == 1 and r.j is None


def test_kept_indices_keep_parallel_arrays_aligned(spark):
    df = spark.createDataFrame([([0.4, 1.0, 2.5, 1.9], ["a", "b", "c", "d"])], "lam array<double>, s array<string>")
    out = df.select(kept_indices("lam", lambda x: lambda_gc_ok(x)).alias("k")) \
        .crossJoin(df).select(take_indices("lam", "k").alias("lam"), take_indices("s", "k").alias("s")).first()
    assert out.lam == [1.0, 1.9] and out.s == ["b", "d"]


def test_kept_indices_empty_array(spark):
    df = spark.createDataFrame([([],)], "lam array<double>")
    assert df.select(kept_indices("lam", lambda x: lambda_gc_ok(x))).first()[0] == []


def test_lambda_bounds_are_strict(spark):
    df = spark.createDataFrame([(0.5,), (2.0,), (0.51,), (None,)], "x double")
    assert [r[0] for r in df.select(lambda_gc_ok("x")).collect()] == [False, False, True, None]


def test_set_equals_ignores_order_and_duplicates(spark):
    df = spark.createDataFrame([(["EUR", "AFR", "EUR"],)], "a array<string>")
    assert df.select(set_equals("a", {"AFR", "EUR"})).first()[0] is True


def test_min_allele_count_any_population(spark):
    df = spark.createDataFrame([({"AFR": 0.1, "EUR": 0.01}, {"AFR": 100, "EUR": 3000})],
                               "af map<string,double>, an map<string,bigint>")
    r = df.select(min_allele_count("af", "an").alias("any"), min_allele_count("af", "an", pops=["AFR"]).alias("afr")).first()
    assert r.any is True and r.afr is False


def test_short_description(spark):
    df = spark.createDataFrame([("Type 2 diabetes mellitus with complications",), ("Height",)], "d string")
    assert [r[0] for r in df.select(ids.short_description("d")).collect()] == ["Type 2 diabetes mellitus...", "Height"]


def test_trait_category(spark):
    df = spark.createDataFrame([("biomarkers",), ("icd10",), ("other",)], "trait_type string")
    assert [r[0] for r in df.select(ids.trait_category()).collect()] == ["quant", "binary", None]


def test_nan_p_value_fails_threshold(spark):
    df = spark.createDataFrame([(float("nan"),)], "p double")
    assert df.select(F.col("p") < 1.0).first()[0] is False
    assert not math.isnan(0.0)
