"""Boundary rules and quirk decisions of SURVEY §1.5 / §5."""

from pyspark.sql import functions as F

from polyscore.operators.filters import clump_text_filter, select_phenos_for_clump
from polyscore.operators.joins import genes_containing, interval_bin_join
from polyscore.plans.evaluate import r2_histogram


def test_histogram_top_edge_in_last_bin(spark):
    corr = spark.createDataFrame([(1, 1.0), (1, 0.0), (1, 0.999), (1, 0.02)], "pid long, prs_corr_r2 double")
    ph = spark.createDataFrame([(1, "icd10")], "pid long, trait_type string")
    got = {r.bin: r.n for r in r2_histogram(corr, ph).collect()}
    assert got == {49: 2, 0: 1, 1: 1}


def test_high_quality_na_passes_text_filter_but_not_variant_filter(spark):
    df = spark.createDataFrame([(1e-3, None, None), (1e-3, False, False), (1e-3, True, True), (None, False, True)],
                               "P double, low_confidence boolean, high_quality boolean")
    text = [r[0] for r in df.select(clump_text_filter("P", "low_confidence", "high_quality")).collect()]
    assert text == [True, False, False, False]
    kept = df.where(F.col("high_quality")).collect()  # P8: NA is dropped
    assert len(kept) == 2 and all(r.high_quality for r in kept)


def test_not_pop_selection_is_six_or_five_lacking(spark):
    ph = spark.createDataFrame([(1, ["AFR", "AMR", "CSA", "EAS", "EUR", "MID"]), (2, ["AFR", "AMR", "CSA", "EAS", "MID"]),
                                (3, ["AFR", "AMR", "CSA", "EAS", "EUR"]), (4, ["EUR"])], "pid long, pops array<string>")
    got = sorted(r.pid for r in select_phenos_for_clump(ph, "EUR", "not_pop").collect())
    assert got == [1, 2]
    assert sorted(r.pid for r in select_phenos_for_clump(ph, "EUR", "single_pop").collect()) == [1, 3, 4]


def test_gene_containment_half_open_and_empty(spark):
    v = spark.createDataFrame([(1, "1", 100), (2, "1", 200), (3, "1", 199), (4, "2", 150)],
                              "vid long, chrom string, pos int")
    g = spark.createDataFrame([("1", 100, 200, "A"), ("1", 150, 400, "B")],
                              "chrom string, start_pos int, end_pos int, gene_name string")
    got = {r.vid: r.nearest_genes for r in genes_containing(v, g, bin_size=64).collect()}
    assert got == {1: ["A"], 2: ["B"], 3: ["A", "B"], 4: []}
    pairs = interval_bin_join(v, g, bin_size=64).count()
    assert pairs == 4


def test_array_index_out_of_range_is_null(spark):
    df = spark.createDataFrame([([1.0, 2.0],)], "a array<double>")
    assert df.select(F.get("a", 5)).first()[0] is None


def test_meta_sets_indices(spark):
    from polyscore.constants import POPS
    from polyscore.operators.meta import meta_sets
    pp = spark.createDataFrame([(1, p) for p in POPS] + [(2, "EUR"), (2, "AFR"), (3, "CSA")], "pid long, pop string")
    got = {(r.pid, r.meta_ix): r.pops_str for r in meta_sets(pp).collect()}
    assert got[(1, 0)] == ",".join(POPS)
    assert got[(1, 5)] == "AFR,AMR,CSA,EAS,MID"  # index k leaves out POPS[k-1]
    assert got[(2, 0)] == "AFR,EUR" and (2, 1) not in got  # leave-one-out sets only for 6 populations
    assert not any(k[0] == 3 for k in got)  # one population: no meta-analysis


def test_densify_thresholds_zero_fill(spark):
    from polyscore.operators.reshape import densify_thresholds
    w = spark.createDataFrame([(1, 1, 2.0, 0.01), (1, 2, float("nan"), 1e-9), (1, 3, None, 1e-9)],
                              "pid long, vid long, beta double, p double")
    rows = {(r.vid, r.p_threshold_name): r.weight for r in densify_thresholds(w).collect()}
    assert len(rows) == 30
    assert rows[(1, "s5")] == 0.0 and rows[(1, "s6")] == 2.0  # strict P < t
    assert rows[(2, "s1")] == 0.0 and rows[(3, "s10")] == 0.0  # NaN / missing beta -> 0
