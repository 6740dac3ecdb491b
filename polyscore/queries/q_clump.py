"""Sample subsets, LD pairs, greedy clumping and clump tallies."""

from __future__ import annotations

from pyspark.sql import functions as F

from polyscore.constants import CLUMP_CHROMOSOMES, POPS
from polyscore.functions import ids
from polyscore.operators import clump as cl
from polyscore.operators import ld
from polyscore.plans import ldclump as lc
from polyscore.plans import subset as sb
from polyscore.queries.q_basic import PHENO_ID_SQL, VARID_SQL
from polyscore.queries.registry import register
from polyscore.session import create_exclusive
from polyscore.sources.fixtures import Fixtures
from polyscore.sources.staged import staged_path

SUBSET_SQL = """
WITH ps AS (SELECT DISTINCT own_pops_str AS pops FROM fx_own_pops),
c AS (SELECT ps.pops, s.user_id, s.s, s.pop FROM ps JOIN fx_sample s ON list_contains(string_split(ps.pops, ','), s.pop)),
sub AS (SELECT pops, user_id, s, pop FROM (SELECT *, row_number() OVER (PARTITION BY pops ORDER BY md5(s || '1'), user_id)
  AS rn FROM c) WHERE rn <= 5000)
"""


@register("sample_subset", SUBSET_SQL + "SELECT * FROM sub")
def sample_subset(spark, sf):
    fx = Fixtures(spark, sf)
    sets = fx.own_pops.select(F.col("own_pops_str").alias("pops")).distinct()
    return sb.sample_subset(fx.sample.select("user_id", "s", "pop"), sets).select("pops", "user_id", "s", "pop")


@register("genotype_subset", SUBSET_SQL + f"""
SELECT sub.pops, v.chrom, d.vid, {VARID_SQL} AS varid, d.user_id, d.dosage
FROM fx_dosage d JOIN sub ON d.user_id = sub.user_id JOIN fx_variant v ON v.vid = d.vid""")
def genotype_subset(spark, sf):
    fx = Fixtures(spark, sf)
    sets = fx.own_pops.select(F.col("own_pops_str").alias("pops")).distinct()
    sub = sb.sample_subset(fx.sample.select("user_id", "s", "pop"), sets)
    return sb.genotype_subset(fx.dosage, sub, fx.variant)


_ALL = ",".join(POPS)
LD_CTE = f"""
WITH RECURSIVE panel AS (SELECT user_id FROM (SELECT s.user_id, row_number() OVER (ORDER BY md5(s.s || '1'), s.user_id) AS rn
  FROM fx_sample s WHERE list_contains(string_split('{_ALL}', ','), s.pop)) WHERE rn <= 5000),
pn AS (SELECT count(*) AS n FROM panel),
g AS (SELECT d.vid, d.user_id, CAST(d.dosage AS BIGINT) AS x FROM fx_dosage d
  WHERE d.user_id IN (SELECT user_id FROM panel) AND d.dosage <> 0),
mom AS (SELECT v.vid, coalesce(sum(g.x), 0) AS sx, coalesce(sum(g.x * g.x), 0) AS sxx FROM fx_variant v
  LEFT JOIN g ON g.vid = v.vid GROUP BY v.vid),
cp AS (SELECT a.vid AS vid_a, b.vid AS vid_b, a.chrom, a.pos AS pos_a, b.pos AS pos_b FROM fx_variant a
  JOIN fx_variant b ON a.chrom = b.chrom AND b.pos - a.pos BETWEEN 0 AND 500000 AND (a.pos < b.pos OR (a.pos = b.pos AND a.vid < b.vid))),
xy AS (SELECT ga.vid AS vid_a, gb.vid AS vid_b, sum(ga.x * gb.x) AS sxy FROM g ga JOIN g gb ON ga.user_id = gb.user_id
  AND ga.vid <> gb.vid GROUP BY 1, 2),
st AS (SELECT cp.*, pn.n * coalesce(xy.sxy, 0) - ma.sx * mb.sx AS num, pn.n * ma.sxx - ma.sx * ma.sx AS da,
  pn.n * mb.sxx - mb.sx * mb.sx AS db FROM cp CROSS JOIN pn JOIN mom ma ON ma.vid = cp.vid_a JOIN mom mb ON mb.vid = cp.vid_b
  LEFT JOIN xy ON xy.vid_a = cp.vid_a AND xy.vid_b = cp.vid_b),
pr AS (SELECT vid_a, vid_b, chrom, pos_a, pos_b, CAST(num * num AS DOUBLE) / CAST(da * db AS DOUBLE) AS r2 FROM st
  WHERE da > 0 AND db > 0 AND CAST(num * num AS DOUBLE) / CAST(da * db AS DOUBLE) >= 0.1),
"""

CLUMP_CTE = LD_CTE + """
cand AS (SELECT m.pid, m.vid, m.p AS P, v.chrom, v.pos FROM fx_min m JOIN fx_variant v ON m.vid = v.vid WHERE m.p <= 1),
ordered AS (SELECT *, row_number() OVER (PARTITION BY pid, chrom ORDER BY P, pos, vid) AS k FROM cand),
edges AS (SELECT a.pid, a.vid AS u, b.vid AS v FROM pr JOIN cand a ON a.vid = pr.vid_a JOIN cand b ON b.vid = pr.vid_b AND b.pid = a.pid
  UNION ALL SELECT a.pid, b.vid AS u, a.vid AS v FROM pr JOIN cand a ON a.vid = pr.vid_a JOIN cand b ON b.vid = pr.vid_b AND b.pid = a.pid),
nb AS (SELECT pid, u, list(v) AS nbrs FROM edges GROUP BY pid, u),
walk(pid, chrom, k, assigned, idx) AS (
  SELECT DISTINCT pid, chrom, CAST(0 AS BIGINT), CAST([] AS BIGINT[]), CAST([] AS BIGINT[]) FROM ordered
  UNION ALL
  SELECT w.pid, w.chrom, w.k + 1,
    CASE WHEN list_contains(w.assigned, o.vid) THEN w.assigned
         ELSE list_concat(w.assigned, list_concat([o.vid], coalesce(n.nbrs, CAST([] AS BIGINT[])))) END,
    CASE WHEN list_contains(w.assigned, o.vid) THEN w.idx ELSE list_append(w.idx, o.vid) END
  FROM walk w JOIN ordered o ON o.pid = w.pid AND o.chrom = w.chrom AND o.k = w.k + 1
  LEFT JOIN nb n ON n.pid = o.pid AND n.u = o.vid),
sizes AS (SELECT pid, chrom, max(k) AS kmax FROM ordered GROUP BY pid, chrom),
index_set AS (SELECT w.pid, unnest(w.idx) AS vid FROM walk w JOIN sizes z ON z.pid = w.pid AND z.chrom = w.chrom AND w.k = z.kmax),
mem AS (SELECT e.pid, e.v AS vid, arg_min(e.u, ou.k) AS index_vid FROM edges e
  JOIN index_set i ON i.pid = e.pid AND i.vid = e.u JOIN ordered ou ON ou.pid = e.pid AND ou.vid = e.u
  WHERE NOT EXISTS (SELECT 1 FROM index_set j WHERE j.pid = e.pid AND j.vid = e.v) GROUP BY e.pid, e.v),
assigned AS (SELECT pid, vid, vid AS index_vid, true AS is_index FROM index_set
  UNION ALL SELECT pid, vid, index_vid, false AS is_index FROM mem)
"""


def _panel_pairs(fx: Fixtures):
    panel = lc.reference_panel(fx.sample.select("user_id", "s", "pop"))
    return ld.panels_ld_pairs(fx.dosage, panel, fx.variant)


def _cands(fx: Fixtures):
    return (fx.min_stat.where("p <= 1").join(fx.variant.select("vid", "chrom", "pos"), "vid")
            .select("pid", "vid", F.col("p").alias("P"), "chrom", "pos"))


@register("ld_pairs", LD_CTE.rstrip().rstrip(",") + "\nSELECT * FROM pr")
def ld_pairs(spark, sf):
    return _panel_pairs(Fixtures(spark, sf)).drop("panel")


@register("ld_clump", CLUMP_CTE.rstrip().rstrip(",") + "\nSELECT * FROM assigned")
def ld_clump(spark, sf):
    fx = Fixtures(spark, sf)
    return cl.ld_clump(_cands(fx), _panel_pairs(fx))


@register("clump_tallies", CLUMP_CTE.rstrip() + f""",
t AS (SELECT a.pid, a.index_vid AS vid, CAST(count(*) AS INTEGER) AS TOTAL,
  CAST(count(*) FILTER (WHERE c.P > 0.05) AS INTEGER) AS NSIG,
  CAST(count(*) FILTER (WHERE c.P > 0.01 AND c.P <= 0.05) AS INTEGER) AS S05,
  CAST(count(*) FILTER (WHERE c.P > 0.001 AND c.P <= 0.01) AS INTEGER) AS S01,
  CAST(count(*) FILTER (WHERE c.P > 0.0001 AND c.P <= 0.001) AS INTEGER) AS S001,
  CAST(count(*) FILTER (WHERE c.P <= 0.0001) AS INTEGER) AS S0001,
  string_agg(vv.varid || '(1)', ',' ORDER BY c.pos, c.vid) AS SP2
  FROM assigned a JOIN cand c ON c.pid = a.pid AND c.vid = a.vid
  JOIN (SELECT vid, {VARID_SQL} AS varid FROM fx_variant) vv ON vv.vid = a.vid
  WHERE NOT a.is_index GROUP BY a.pid, a.index_vid)
SELECT i.pid, i.vid, c.chrom AS CHR, 1 AS F, {VARID_SQL.replace('chrom', 'c.chrom').replace('CAST(pos', 'CAST(c.pos').replace('ref', 'v.ref').replace('alt', 'v.alt')} AS SNP,
  c.pos AS BP, c.P, coalesce(t.TOTAL, 0) AS TOTAL, coalesce(t.NSIG, 0) AS NSIG, coalesce(t.S05, 0) AS S05,
  coalesce(t.S01, 0) AS S01, coalesce(t.S001, 0) AS S001, coalesce(t.S0001, 0) AS S0001, coalesce(t.SP2, 'NONE') AS SP2
FROM assigned i JOIN cand c ON c.pid = i.pid AND c.vid = i.vid JOIN fx_variant v ON v.vid = i.vid
LEFT JOIN t ON t.pid = i.pid AND t.vid = i.vid WHERE i.is_index""")
def clump_tallies(spark, sf):
    fx = Fixtures(spark, sf)
    cands = _cands(fx)
    assigned = cl.ld_clump(cands, _panel_pairs(fx))
    return cl.clump_tallies(assigned, cands, fx.variant.select("vid", ids.variant_id().alias("varid")))


def panels_ld_cte(panel_sets_sql: str) -> str:
    """Oracle CTEs for LD pairs of several panels (panel = population set joined by ',')."""
    return f"""
WITH RECURSIVE panel_sets AS ({panel_sets_sql}),
panel AS (SELECT panel, user_id FROM (SELECT ps.panel, s.user_id,
  row_number() OVER (PARTITION BY ps.panel ORDER BY md5(s.s || '1'), s.user_id) AS rn
  FROM panel_sets ps JOIN fx_sample s ON list_contains(string_split(ps.panel, ','), s.pop)) WHERE rn <= 5000),
pn AS (SELECT panel, count(*) AS n FROM panel GROUP BY panel),
g AS (SELECT p.panel, d.vid, d.user_id, CAST(d.dosage AS BIGINT) AS x FROM fx_dosage d JOIN panel p ON d.user_id = p.user_id
  WHERE d.dosage <> 0),
mom AS (SELECT panel, vid, sum(x) AS sx, sum(x * x) AS sxx FROM g GROUP BY panel, vid),
cp AS (SELECT a.vid AS vid_a, b.vid AS vid_b, a.chrom, a.pos AS pos_a, b.pos AS pos_b FROM fx_variant a
  JOIN fx_variant b ON a.chrom = b.chrom AND b.pos - a.pos BETWEEN 0 AND 500000 AND (a.pos < b.pos OR (a.pos = b.pos AND a.vid < b.vid))),
xy AS (SELECT ga.panel, ga.vid AS vid_a, gb.vid AS vid_b, sum(ga.x * gb.x) AS sxy FROM g ga JOIN g gb
  ON ga.panel = gb.panel AND ga.user_id = gb.user_id AND ga.vid <> gb.vid GROUP BY 1, 2, 3),
st AS (SELECT ma.panel, cp.*, pn.n * coalesce(xy.sxy, 0) - ma.sx * mb.sx AS num, pn.n * ma.sxx - ma.sx * ma.sx AS da,
  pn.n * mb.sxx - mb.sx * mb.sx AS db FROM cp JOIN mom ma ON ma.vid = cp.vid_a
  JOIN mom mb ON mb.vid = cp.vid_b AND mb.panel = ma.panel JOIN pn ON pn.panel = ma.panel
  LEFT JOIN xy ON xy.panel = ma.panel AND xy.vid_a = cp.vid_a AND xy.vid_b = cp.vid_b),
pr AS (SELECT panel, vid_a, vid_b, chrom, pos_a, pos_b, CAST(num * num AS DOUBLE) / CAST(da * db AS DOUBLE) AS r2 FROM st
  WHERE da > 0 AND db > 0 AND CAST(num * num AS DOUBLE) / CAST(da * db AS DOUBLE) >= 0.1),
"""


def clump_chain_sql(cand_sql: str) -> str:
    """Oracle CTE chain: sequential greedy clump (recursive CTE) of candidates (pheno_id, panel, vid, P, chrom, pos)."""
    return panels_ld_cte("SELECT DISTINCT panel FROM cand0") .replace(
        "WITH RECURSIVE panel_sets", f"WITH RECURSIVE cand0 AS ({cand_sql}),\npanel_sets") + f"""
cand AS (SELECT * FROM cand0 WHERE P <= 1),
ordered AS (SELECT *, row_number() OVER (PARTITION BY pheno_id, chrom ORDER BY P, pos, vid) AS k FROM cand),
edges AS (SELECT a.pheno_id, a.vid AS u, b.vid AS v FROM pr JOIN cand a ON a.vid = pr.vid_a AND a.panel = pr.panel
    JOIN cand b ON b.vid = pr.vid_b AND b.pheno_id = a.pheno_id
  UNION ALL SELECT a.pheno_id, b.vid AS u, a.vid AS v FROM pr JOIN cand a ON a.vid = pr.vid_a AND a.panel = pr.panel
    JOIN cand b ON b.vid = pr.vid_b AND b.pheno_id = a.pheno_id),
nb AS (SELECT pheno_id, u, list(v) AS nbrs FROM edges GROUP BY pheno_id, u),
walk(pheno_id, chrom, k, assigned, idx) AS (
  SELECT DISTINCT pheno_id, chrom, CAST(0 AS BIGINT), CAST([] AS BIGINT[]), CAST([] AS BIGINT[]) FROM ordered
  UNION ALL
  SELECT w.pheno_id, w.chrom, w.k + 1,
    CASE WHEN list_contains(w.assigned, o.vid) THEN w.assigned
         ELSE list_concat(w.assigned, list_concat([o.vid], coalesce(n.nbrs, CAST([] AS BIGINT[])))) END,
    CASE WHEN list_contains(w.assigned, o.vid) THEN w.idx ELSE list_append(w.idx, o.vid) END
  FROM walk w JOIN ordered o ON o.pheno_id = w.pheno_id AND o.chrom = w.chrom AND o.k = w.k + 1
  LEFT JOIN nb n ON n.pheno_id = o.pheno_id AND n.u = o.vid),
sizes AS (SELECT pheno_id, chrom, max(k) AS kmax FROM ordered GROUP BY pheno_id, chrom),
index_set AS (SELECT w.pheno_id, unnest(w.idx) AS vid FROM walk w JOIN sizes z ON z.pheno_id = w.pheno_id
  AND z.chrom = w.chrom AND w.k = z.kmax),
mem AS (SELECT e.pheno_id, e.v AS vid, arg_min(e.u, ou.k) AS index_vid FROM edges e
  JOIN index_set i ON i.pheno_id = e.pheno_id AND i.vid = e.u JOIN ordered ou ON ou.pheno_id = e.pheno_id AND ou.vid = e.u
  WHERE NOT EXISTS (SELECT 1 FROM index_set j WHERE j.pheno_id = e.pheno_id AND j.vid = e.v) GROUP BY e.pheno_id, e.v),
assigned AS (SELECT pheno_id, vid, vid AS index_vid, true AS is_index FROM index_set
  UNION ALL SELECT pheno_id, vid, index_vid, false AS is_index FROM mem)"""


def clump_job_sql(cand_sql: str) -> str:
    """Oracle: clump chain + PLINK-style tallies of every index variant."""
    return clump_chain_sql(cand_sql) + f""",
vv AS (SELECT vid, {VARID_SQL} AS varid FROM fx_variant),
t AS (SELECT a.pheno_id, a.index_vid AS vid, CAST(count(*) AS INTEGER) AS TOTAL,
  CAST(count(*) FILTER (WHERE c.P > 0.05) AS INTEGER) AS NSIG,
  CAST(count(*) FILTER (WHERE c.P > 0.01 AND c.P <= 0.05) AS INTEGER) AS S05,
  CAST(count(*) FILTER (WHERE c.P > 0.001 AND c.P <= 0.01) AS INTEGER) AS S01,
  CAST(count(*) FILTER (WHERE c.P > 0.0001 AND c.P <= 0.001) AS INTEGER) AS S001,
  CAST(count(*) FILTER (WHERE c.P <= 0.0001) AS INTEGER) AS S0001,
  string_agg(vv.varid || '(1)', ',' ORDER BY c.pos, c.vid) AS SP2
  FROM assigned a JOIN cand c ON c.pheno_id = a.pheno_id AND c.vid = a.vid JOIN vv ON vv.vid = a.vid
  WHERE NOT a.is_index GROUP BY a.pheno_id, a.index_vid)
SELECT i.pheno_id, i.vid, c.chrom AS CHR, 1 AS F, vv.varid AS SNP, c.pos AS BP, c.P,
  coalesce(t.TOTAL, 0) AS TOTAL, coalesce(t.NSIG, 0) AS NSIG, coalesce(t.S05, 0) AS S05, coalesce(t.S01, 0) AS S01,
  coalesce(t.S001, 0) AS S001, coalesce(t.S0001, 0) AS S0001, coalesce(t.SP2, 'NONE') AS SP2
FROM assigned i JOIN cand c ON c.pheno_id = i.pheno_id AND c.vid = i.vid JOIN vv ON vv.vid = i.vid
LEFT JOIN t ON t.pheno_id = i.pheno_id AND t.vid = i.vid WHERE i.is_index"""


_PHENO_ID = PHENO_ID_SQL

CAND_SINGLE_EUR = f"""SELECT {_PHENO_ID} AS pheno_id, 'EUR' AS panel, s.vid, s.p AS P, v.chrom, v.pos
  FROM fx_sumstats s JOIN fx_pheno ph ON s.pid = ph.pid JOIN fx_variant v ON s.vid = v.vid
  WHERE s.pop = 'EUR' AND s.p IS NOT NULL AND coalesce(NOT s.low_confidence, true) AND coalesce(v.high_quality, true)"""

CAND_MAX_POPS = f"""SELECT {_PHENO_ID} AS pheno_id, o.own_pops_str AS panel, m.vid, m.p AS P, v.chrom, v.pos
  FROM fx_meta m JOIN fx_num_pops n ON m.pid = n.pid JOIN fx_pheno ph ON m.pid = ph.pid JOIN fx_variant v ON m.vid = v.vid
  JOIN fx_own_pops o ON o.pid = m.pid
  WHERE n.num_pops > 1 AND m.meta_ix = 0 AND m.p IS NOT NULL AND coalesce(v.high_quality, true)
  UNION ALL
  SELECT {_PHENO_ID} AS pheno_id, o.own_pops_str AS panel, s.vid, s.p AS P, v.chrom, v.pos
  FROM fx_sumstats s JOIN fx_num_pops n ON s.pid = n.pid JOIN fx_pheno ph ON s.pid = ph.pid JOIN fx_variant v ON s.vid = v.vid
  JOIN fx_own_pops o ON o.pid = s.pid
  WHERE n.num_pops = 1 AND s.p IS NOT NULL AND coalesce(NOT s.low_confidence, true) AND coalesce(v.high_quality, true)"""


def _clump_job(spark, sf, selection, pop=None):
    fx = Fixtures(spark, sf)
    assigned, cands = lc.clump_job(fx, selection=selection, pop=pop)
    varids = fx.variant.select("vid", ids.variant_id().alias("varid"))
    return cl.clump_tallies(assigned, cands, varids, key="pheno_id")


@register("clump_job_single", clump_job_sql(CAND_SINGLE_EUR))
def clump_job_single(spark, sf):
    return _clump_job(spark, sf, "single_pop", "EUR")


@register("clump_job_max_pops", clump_job_sql(CAND_MAX_POPS))
def clump_job_max_pops(spark, sf):
    return _clump_job(spark, sf, "max_pops")


@register("ld_pairs_panels", panels_ld_cte("SELECT DISTINCT own_pops_str AS panel FROM fx_own_pops").rstrip().rstrip(",")
          + "\nSELECT * FROM pr")
def ld_pairs_panels(spark, sf):
    fx = Fixtures(spark, sf)
    sets = fx.own_pops.select(F.col("own_pops_str").alias("panel")).distinct()
    return ld.panels_ld_pairs(fx.dosage, lc.panel_samples(fx.sample.select("user_id", "s", "pop"), sets), fx.variant)


@register("genotype_subset_files", SUBSET_SQL + f"""
SELECT sub.pops, v.chrom, d.vid, {VARID_SQL} AS varid, d.user_id, d.dosage
FROM fx_dosage d JOIN sub ON d.user_id = sub.user_id JOIN fx_variant v ON v.vid = d.vid""")
def genotype_subset_files(spark, sf):
    """Subset genotypes written by population set and chromosome, then read back."""
    from polyscore.session import scratch_path
    from polyscore.sources.genotypes import read_by_chrom
    fx = Fixtures(spark, sf)
    sets = fx.own_pops.select(F.col("own_pops_str").alias("pops")).distinct()
    sub = sb.sample_subset(fx.sample.select("user_id", "s", "pop"), sets)
    path = scratch_path(spark, "genotype_subset")
    sb.write_genotype_subset(sb.genotype_subset(fx.dosage, sub, fx.variant), path)
    return read_by_chrom(spark, path).select("pops", "chrom", "vid", "varid", "user_id", "dosage")


CAND_NOT_EUR = f"""SELECT {_PHENO_ID} AS pheno_id, 'AFR,AMR,CSA,EAS,MID' AS panel, m.vid, m.p AS P, v.chrom, v.pos
  FROM fx_meta m JOIN fx_num_pops n ON m.pid = n.pid JOIN fx_pheno ph ON m.pid = ph.pid JOIN fx_variant v ON m.vid = v.vid
  WHERE n.num_pops = 6 AND m.meta_ix = 5 AND m.p IS NOT NULL
  UNION ALL
  SELECT {_PHENO_ID} AS pheno_id, 'AFR,AMR,CSA,EAS,MID' AS panel, m.vid, m.p AS P, v.chrom, v.pos
  FROM fx_meta m JOIN fx_num_pops n ON m.pid = n.pid JOIN fx_pheno ph ON m.pid = ph.pid JOIN fx_variant v ON m.vid = v.vid
  WHERE n.num_pops = 5 AND m.pid NOT IN (SELECT pid FROM fx_pheno_pop WHERE pop = 'EUR')
    AND m.meta_ix = 0 AND m.p IS NOT NULL AND coalesce(v.high_quality, true)"""


@register("clump_job_not_pop", clump_job_sql(CAND_NOT_EUR))
def clump_job_not_pop(spark, sf):
    return _clump_job(spark, sf, "not_pop", "EUR")


def _sets_cand_sql() -> str:
    """Candidates of the twelve sets; the job takes the place of the phenotype id in the clump chain."""
    number = {n: i for i, n in enumerate(lc.CLUMP_SETS)}
    contigs = ", ".join(f"'{c}'" for c in CLUMP_CHROMOSOMES)
    own = case_of("s.pop", {p: number[p] for p in POPS})
    out_ix = case_of("m.meta_ix", {i + 1: number[f"not_{p}"] for i, p in enumerate(POPS)})
    lacks = case_of("x.pop", {p: number[f"not_{p}"] for p in POPS})
    panel = case_of("job % 12", {i: f"'{lc.set_panel(n)}'" for n, i in number.items()})
    return f"""SELECT job AS pheno_id, {panel} AS panel, vid, P, chrom, pos FROM (
  SELECT s.pid * 12 + {own} AS job, s.vid, s.p AS P, v.chrom, v.pos FROM fx_sumstats s JOIN fx_variant v ON s.vid = v.vid
  JOIN fx_pheno_pop pp ON pp.pid = s.pid AND pp.pop = s.pop
  WHERE s.p IS NOT NULL AND coalesce(NOT s.low_confidence, true) AND coalesce(v.high_quality, true)
  UNION ALL SELECT m.pid * 12 + {out_ix}, m.vid, m.p, v.chrom, v.pos FROM fx_meta m JOIN fx_num_pops n ON m.pid = n.pid
  JOIN fx_variant v ON m.vid = v.vid WHERE n.num_pops = 6 AND m.meta_ix > 0 AND m.p IS NOT NULL
  UNION ALL SELECT m.pid * 12 + {lacks}, m.vid, m.p, v.chrom, v.pos FROM fx_meta m JOIN fx_num_pops n ON m.pid = n.pid
  JOIN (SELECT n.pid, a.pop FROM fx_num_pops n CROSS JOIN (SELECT unnest({POPS!r}) AS pop) a
        WHERE NOT EXISTS (SELECT 1 FROM fx_pheno_pop q WHERE q.pid = n.pid AND q.pop = a.pop)) x ON x.pid = m.pid
  JOIN fx_variant v ON m.vid = v.vid
  WHERE n.num_pops = 5 AND m.meta_ix = 0 AND m.p IS NOT NULL AND coalesce(v.high_quality, true)) WHERE chrom IN ({contigs})"""


def case_of(column: str, values: dict) -> str:
    quoted = lambda k: f"'{k}'" if isinstance(k, str) else k
    return f"CASE {column} " + " ".join(f"WHEN {quoted(k)} THEN {v}" for k, v in values.items()) + " END"


def sets_sql(tail: str) -> str:
    """The clump matrix of the twelve sets as CTE ``matrix``, then ``tail``."""
    chain, rows = clump_job_sql(_sets_cand_sql()).rsplit("\nSELECT i.pheno_id", 1)
    sets = case_of("pheno_id % 12", {i: f"'{n}'" for i, n in enumerate(lc.CLUMP_SETS)})
    panel = case_of("pheno_id % 12", {i: f"'{lc.set_panel(n)}'" for i, n in enumerate(lc.CLUMP_SETS)})
    return f"""{chain},
job_rows AS (SELECT i.pheno_id{rows}),
matrix AS (SELECT pheno_id // 12 AS pid, vid, {panel} AS clump_pops_str, P, TOTAL, NSIG, S05, S01, S001, S0001, SP2,
  {sets} AS "set" FROM job_rows)
{tail}"""


def _matrix(spark, sf):
    """The twelve sets' results, clumped once per session and input."""
    base = staged_path(spark, sf, "clump_sets", lambda path: _build_sets(spark, sf, path))
    return lc.clump_sets(Fixtures(spark, sf), base)


def _build_sets(spark, sf, path):
    lc.clump_sets(Fixtures(spark, sf), path)
    create_exclusive(spark, f"{path}/_SUCCESS")


@register("clump_sets", sets_sql("SELECT * FROM matrix"))
def clump_sets(spark, sf):
    """Clump results of every phenotype on the six single-population and six leave-one-out sets."""
    return _matrix(spark, sf)


@register("full_clump_sets", sets_sql("""SELECT pid, vid, string_agg(clump_pops_str, ';' ORDER BY clump_pops_str) AS clump_pops,
  CAST(count(*) AS INTEGER) AS n_sets, CAST(sum(TOTAL) AS BIGINT) AS sum_total FROM matrix GROUP BY pid, vid"""))
def full_clump_sets(spark, sf):
    """The twelve clump results joined per (phenotype, variant)."""
    from polyscore.plans.clumping import full_clump
    return full_clump([_matrix(spark, sf).select("pid", "vid", "clump_pops_str", "TOTAL")])


@register("prs_weights_sets", sets_sql("""SELECT c.pid, c.clump_pops_str, c.vid, coalesce(c.beta, s.beta) AS beta, coalesce(c.p, s.p) AS p
FROM (SELECT m.pid, d.pops_str AS clump_pops_str, m.vid, m.beta, m.p, 0 AS source FROM fx_meta m
    JOIN fx_meta_data d ON m.pid = d.pid AND m.meta_ix = d.meta_ix
  UNION ALL SELECT pid, pop, vid, beta, p, 1 FROM fx_sumstats
    WHERE (pid, pop) NOT IN (SELECT pid, pops_str FROM fx_meta_data)) c
JOIN matrix cl ON cl.pid = c.pid AND cl.vid = c.vid AND cl.clump_pops_str = c.clump_pops_str
LEFT JOIN fx_sumstats s ON s.pid = c.pid AND s.vid = c.vid AND s.pop = c.clump_pops_str"""))
def prs_weights_sets(spark, sf):
    """Score weights of every column that has a clump result in one of the twelve sets."""
    from polyscore.plans import prs
    fx = Fixtures(spark, sf)
    return prs.prs_weights(fx.meta, fx.meta_data, fx.sumstats, _matrix(spark, sf), fx.pheno_pop)
