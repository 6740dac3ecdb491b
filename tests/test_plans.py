"""Plan checks over every registered query: no cartesian or nested-loop joins, no row-at-a-time Python UDFs."""

import pytest

import __spark_entry__ as ent

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"]


@pytest.mark.parametrize("name", sorted(ent.queries()))
def test_plan_has_no_cartesian_or_row_udf(spark, sf_small, name):
    df = ent.queries()[name](spark, sf_small)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    bad = [op for op in FORBIDDEN if op in plan]
    assert not bad, f"{name}: {bad}"


def test_flagship_pushes_projection_to_scan(spark, sf_small):
    df = ent.queries()["prs_thresholds"](spark, sf_small)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    # the genotypes are read with all of their three columns, the statistics without those that scores don't use
    assert "ReadSchema: struct<user_id:bigint,vid:bigint,dosage:double>" in plan
    assert not any(c in plan for c in ("l_extendedprice", "af_controls", "p_het"))


def test_region_query_prunes_partitions(spark, sf_small):
    df = ent.queries()["region_query"](spark, sf_small)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    filters = plan[plan.index("PartitionFilters: [") + len("PartitionFilters: ["):]
    assert "chrom" in filters[:filters.index("]")]
    pushed = plan[plan.index("PushedFilters: [") + len("PushedFilters: ["):]
    assert "pos" in pushed[:pushed.index("]")]


def test_bucketed_genotypes_join_without_genotype_shuffle(spark, sf_small):
    """With broadcast off (as at scale) only the weights are shuffled to the genotype bucket layout."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        q = ent.queries()
        bucketed = q["prs_bucketed"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
        plain = q["prs_thresholds"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Bucketed: true" in bucketed and "SortMergeJoin" in bucketed
    assert bucketed.count("Exchange hashpartitioning(vid") == 1
    assert plain.count("Exchange hashpartitioning(vid") == 2


def test_sample_subset_limits_groups_before_shuffle(spark, sf_small):
    plan = ent.queries()["sample_subset"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
