"""Spark result = DuckDB oracle on the smallest driver tables (a representative subset by default).

Set POLYSCORE_FULL_ORACLE=1 to check every registered query.
"""

import math
import os

import duckdb
import pytest

import __spark_entry__ as ent

SUBSET = ["matrix_scan", "final_sumstats", "wide_export_binary", "loo_pvalues", "pheno_manifest", "ma_format",
          "prs_weights", "prs_clumped", "multiway_zip", "gene_overlap", "fix_alleles", "rank_by_p", "sample_subset",
          "ld_clump", "clump_tallies", "score_corr", "case_control_ttest", "clump_text_scan", "format_stat",
          "resume_missing_parts", "separate_by_pop", "axis_index", "clump_job_single", "clump_job_not_pop",
          "coalesce_qc", "filtered_genotypes", "varid_listing", "prs_bucketed", "prs_labeled", "wide_export_files"]
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None or v is getattr(__import__("pandas"), "NA"):
        return None
    if hasattr(v, "item") and not isinstance(v, (list, tuple)):
        try:
            v = v.item()
        except (ValueError, AttributeError):
            pass
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer():
            return int(v)
        return float(f"{v:.9g}")
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)), key=repr)


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return c


NAMES = sorted(ent.oracle_sql()) if os.environ.get("POLYSCORE_FULL_ORACLE") else SUBSET


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, sf_small, name):
    got = ent.queries()[name](spark, sf_small).toPandas()
    want = con.execute(ent.oracle_sql()[name]).df()
    assert _rows(got) == _rows(want)


def test_every_oracle_has_a_query():
    assert set(ent.oracle_sql()) <= set(ent.queries())
