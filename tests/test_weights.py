"""Weight preparation: holes of a meta column are filled from its single-population twin."""

from polyscore.operators import clump
from polyscore.plans import prs


def test_holes_filled_from_the_dropped_twin(spark):
    meta = spark.createDataFrame([(1, 0, 10, None, 0.5), (1, 0, 11, 1.0, None), (1, 0, 12, 3.0, float("nan"))],
                                 "pid long, meta_ix int, vid long, beta double, p double")
    meta_data = spark.createDataFrame([(1, 0, "EUR")], "pid long, meta_ix int, pops_str string")
    single = spark.createDataFrame([(1, "EUR", 10, 2.0, 0.1), (1, "EUR", 11, 9.0, 0.2), (1, "EUR", 12, 9.0, 0.3)],
                                   "pid long, pop string, vid long, beta double, p double")
    rows = spark.createDataFrame([(1, v, "EUR", 1) for v in (10, 11, 12)],
                                 "pid long, vid long, clump_pops_str string, TOTAL int")
    got = {r.vid: (r.beta, r.p) for r in prs.prs_weights(meta, meta_data, single, rows).collect()}
    assert got[10] == (2.0, 0.5)
    assert got[11] == (1.0, 0.2)
    assert got[12][0] == 3.0 and got[12][1] != got[12][1]


def test_clump_settles_a_long_chain(spark):
    n = 8
    cands = spark.createDataFrame([(1, v, 10.0 ** (v - 12), v * 10) for v in range(n)], "pid long, vid long, P double, pos long")
    pairs = spark.createDataFrame([(v, v + 1, "1", v * 10, v * 10 + 10) for v in range(n - 1)],
                                  "vid_a long, vid_b long, chrom string, pos_a long, pos_b long")
    got = clump.ld_clump(cands, pairs, p1=1.0, p2=1.0).collect()
    assert len(got) == n
    assert {r.vid for r in got if r.is_index} == {0, 2, 4, 6}
