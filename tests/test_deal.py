"""Steps that sort or group rows run in as many tasks as these fill, and ship a row once."""

import pytest
from pyspark.sql import functions as F

from polyscore.operators import deal
from polyscore.operators.joins import zip_join
from polyscore.operators.meta import meta_analysis
from polyscore.plans.export import wide_export
from polyscore.plans.subset import genotype_subset


def _plan(df):
    return df._jdf.queryExecution().sparkPlan().toString()


@pytest.fixture
def few(monkeypatch):
    monkeypatch.setattr(deal, "TASK_ROWS", 10)


def test_zip_join_deals_by_rows_and_refuses_a_key_twice(spark, few):
    a = spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("value"))
    b = spark.range(50, 150).select(F.col("id").alias("k"), F.when(F.col("id") != 60, F.col("id")).alias("value"))
    z = zip_join([a, b], ["k"])
    assert z.rdd.getNumPartitions() == 20 and "REPARTITION_BY_NUM" in _plan(z)
    want = {k: [k * 2 if k < 100 else None, k if k >= 50 and k != 60 else None] for k in range(150)}
    assert {r.k: list(r["values"]) for r in z.collect()} == want
    with pytest.raises(Exception, match="key twice"):
        zip_join([a, b.unionByName(b)], ["k"]).collect()


def test_meta_analysis_ships_a_statistic_once(spark):
    stats = spark.sql("SELECT 1 + id DIV 100 AS pid, id vid, pop, 2D beta, 1D se, 5e-1 p, 1L n, 1D af, 1D af_cases, 1D af_controls, false low_confidence "
                      "FROM range(20) LATERAL VIEW explode(array('AFR', 'EUR')) AS pop")
    sets = spark.createDataFrame([(1, 0, ["AFR", "EUR"]), (1, 1, ["EUR"]), (1, 2, ["AFR"])], "pid long, meta_ix int, pops array<string>")
    m = meta_analysis(stats, sets, 13)
    plan = _plan(m)
    assert m.rdd.getNumPartitions() == 13
    assert "explode(_sets" in plan[:plan.index("REPARTITION_BY_NUM")]  # after the shuffle
    assert {(r.vid, r.meta_ix): (r.beta, r.n) for r in m.collect()} == {
        (v, k): (4.0, 2) if k == 0 else (2.0, 1) for v in range(20) for k in range(3)}


def test_genotypes_are_repeated_for_sets_after_the_last_shuffle(spark, few):
    dosage = spark.range(40).select((F.col("id") % 4).alias("user_id"), F.col("id").alias("vid"), F.lit(1.0).alias("dosage"))
    subset = spark.createDataFrame([("EUR", 0), ("AFR,EUR", 0), ("AFR,EUR", 1), ("AFR,EUR", 1)], "pops string, user_id long")
    variants = spark.range(40).selectExpr("id AS vid", "'1' AS chrom", "1 AS pos", "'A' AS ref", "'C' AS alt")
    got = genotype_subset(dosage, subset, variants)
    plan = _plan(got)
    assert plan.index("explode(_sets") < plan.index("REPARTITION_BY_NUM")
    assert got.groupBy("pops", "user_id").count().collect().__len__() == 3 and got.count() == 40


def test_wide_rows_travel_as_numbers(spark, sf_small):
    from polyscore.sources.fixtures import Fixtures
    fx = Fixtures(spark, sf_small)
    plan = _plan(wide_export(fx.sumstats, fx.meta, fx.pheno, fx.own_pops, fx.variant, category="quant"))
    assert "format_string" not in plan[plan.index("Join"):]


def test_clump_text_is_dealt_by_rows_and_its_blank_lines_stay_blank(spark, sf_small, monkeypatch):
    from polyscore.queries.q_basic import _clump_text_rows
    from polyscore.sources.fixtures import Fixtures
    monkeypatch.setattr(deal, "TASK_ROWS", 1000)
    fx = Fixtures(spark, sf_small)
    rows = _clump_text_rows(fx)
    assert rows.rdd.getNumPartitions() == fx.tasks > 4
    blank = rows.where("trim(contig) = ''")
    assert blank.count() == 2 * fx.pheno.count()
    assert blank.dropna(how="all", subset=[c for c in rows.columns if c not in ("pid", "contig")]).count() == 0


def test_contig_files_follow_the_rows_not_the_text_files(spark, sf_small):
    from polyscore.queries.q_basic import clump_concat
    from polyscore.sources.fixtures import Fixtures
    files = clump_concat(spark, sf_small).inputFiles()
    assert len(files) <= 22 + Fixtures(spark, sf_small).tasks


def test_columns_of_an_external_study_need_no_annotated_rows(spark, tmp_path):
    from polyscore.plans.ingest import external_results
    (spark.sql("SELECT '1' AS `#chrom`, 5 AS pos, 'A' AS ref, 'C' AS alt, 1e-1 AS pval, 'rs1' AS rsids, '' AS nearest_genes, k AS phenocode "
               "FROM VALUES ('x'), ('y') t(k)").write.partitionBy("phenocode").option("sep", "\t").option("header", True).csv(f"{tmp_path}/f"))
    man = spark.sql("SELECT k AS phenocode, 'c' AS category, k AS name, 1 AS n_cases, 2 AS n_controls FROM VALUES ('x'), ('x'), ('y'), ('z') t(k)")
    vep = spark.sql("SELECT '1' AS chrom, 5 AS pos, 'A' AS ref, 'C' AS alt, 'G' AS gene, 'm' AS annotation")
    rows, cols, entries = external_results(spark, f"{tmp_path}/f", man, vep)
    assert sorted(tuple(r) for r in cols.collect()) == [("x", "c", "x", 1, 2), ("y", "c", "y", 1, 2)]
    assert "pos" not in _plan(cols)
    assert rows.count() == 1 and entries.count() == 3


def test_wide_rows_and_their_meta_analysis_are_shuffled_once_by_variant(spark, sf_small, monkeypatch):
    import re

    from polyscore.sources.fixtures import Fixtures
    fx = Fixtures(spark, sf_small)
    tables = fx.sumstats, fx.meta, fx.pheno, fx.own_pops, fx.variant
    monkeypatch.setattr(deal, "TASK_ROWS", 500)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if phenotypes and variants were many
    try:
        plan = wide_export(*tables, category="quant")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    keys = [re.sub(r"#\d+L?", "", k) for k in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)]
    assert keys.count("vid") == 2 and not any("pid" in k and "vid" in k for k in keys)  # the rows and the variants


def test_numbers_of_the_wide_export_are_the_same_as_text(spark, sf_small):
    from polyscore.plans.export import as_text
    from polyscore.sources.fixtures import Fixtures
    fx = Fixtures(spark, sf_small)
    for category in ("quant", "binary"):
        numbers, text = (wide_export(fx.sumstats, fx.meta, fx.pheno, fx.own_pops, fx.variant, category=category, text=t) for t in (False, True))
        assert dict(numbers.dtypes)["beta_EUR"] == "double" and dict(text.dtypes)["beta_EUR"] == "string"
        rows = [sorted(map(repr, df.collect())) for df in (as_text(numbers), text, as_text(text))]
        assert rows[0] and rows[0] == rows[1] == rows[2]


def test_inputs_are_staged_in_as_many_tasks_as_rows_fill(spark, sf_small, monkeypatch, tmp_path):
    from types import SimpleNamespace

    from polyscore.sources import fixtures, staged
    monkeypatch.setattr(deal, "TASK_ROWS", 100)
    key, seen = "spark.sql.shuffle.partitions", []
    fx = fixtures.Fixtures(spark, sf_small, stage=False)
    lines = fx.table("lineitem").count()
    assert fx.meta.rdd.getNumPartitions() == -(-fixtures.META_ROWS * lines // 100)

    def parquet(path):
        seen.append(int(spark.conf.get(key)))
        spark.range(3).write.parquet(path)

    monkeypatch.setattr(fx, "derived", lambda name: SimpleNamespace(write=SimpleNamespace(mode=lambda m: SimpleNamespace(parquet=parquet))), raising=False)
    monkeypatch.setattr(staged, "staged_path", lambda s, sf, name, build: build(str(tmp_path / "rows")) or str(tmp_path / "rows"))
    before = spark.conf.get(key)
    assert fx.staged("stat").count() == 3 and seen == [-(-lines // 100)] and spark.conf.get(key) == before
