"""Property tests on random small inputs: bin joins and zip joins equal their brute-force definitions."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from polyscore.operators.joins import interval_bin_join, zip_join

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

points = st.lists(st.tuples(st.sampled_from(["1", "2"]), st.integers(0, 2000)), min_size=1, max_size=30)
intervals = st.lists(st.tuples(st.sampled_from(["1", "2"]), st.integers(0, 2000), st.integers(1, 900)),
                     min_size=1, max_size=12)


@SETTINGS
@given(points, intervals, st.sampled_from([7, 64, 500, 5000]), st.booleans())
def test_interval_bin_join_equals_brute_force(spark, pts, ivs, bin_size, inclusive):
    p = spark.createDataFrame([(i, c, x) for i, (c, x) in enumerate(pts)], "vid long, chrom string, pos int")
    g = spark.createDataFrame([(c, s, s + L, f"g{j}") for j, (c, s, L) in enumerate(ivs)],
                              "chrom string, start_pos int, end_pos int, gene_name string")
    got = sorted((r.vid, r.gene_name) for r in
                 interval_bin_join(p, g, bin_size=bin_size, end_inclusive=inclusive).select("vid", "gene_name").collect())
    want = sorted((i, f"g{j}") for i, (c, x) in enumerate(pts) for j, (c2, s, L) in enumerate(ivs)
                  if c == c2 and s <= x and (x <= s + L if inclusive else x < s + L))
    assert got == want


@SETTINGS
@given(st.lists(st.dictionaries(st.integers(0, 15), st.integers(-5, 5), max_size=10), min_size=1, max_size=5))
def test_zip_join_equals_dict_merge(spark, tables):
    dfs = [spark.createDataFrame([(k, v) for k, v in t.items()] or [(None, None)], "k int, value int").where("k IS NOT NULL")
           for t in tables]
    got = {r.k: list(r.values) for r in zip_join(dfs, ["k"]).collect()}
    keys = set().union(*[t.keys() for t in tables])
    want = {k: [t.get(k) for t in tables] for k in keys}
    assert got == want
