"""DuckDB definitions of the fixture views, prepended to oracle SQL as CTEs.

They mirror ``polyscore.sources.fixtures`` expression by expression; integer
division is ``//`` here and ``DIV`` in Spark.
"""

from __future__ import annotations

import re

from polyscore.constants import POPS, TRAIT_TYPES
from polyscore.sources.fixtures import case_index, p_denominator

_POPS_VALUES = ", ".join(f"({i}, '{p}')" for i, p in enumerate(POPS))


def _thresholds_values() -> str:
    from polyscore.constants import P_THRESHOLDS
    return ", ".join(f"({i}, '{n}', {t!r})" for i, (n, t) in enumerate(P_THRESHOLDS))


FX_SQL: dict[str, str] = {
    "fx_pops": f"SELECT * FROM (VALUES {_POPS_VALUES}) AS t(pop_ix, pop)",
    "fx_thresholds": None,  # set below
    "fx_variant": (
        "SELECT p_partkey AS vid, CAST(1 + p_partkey % 22 AS VARCHAR) AS chrom, "
        "CAST(1000 + (p_partkey // 22) * 20000 AS INTEGER) AS pos, "
        "substr('ACGT', CAST(p_partkey % 4 AS INTEGER) + 1, 1) AS ref, "
        "substr('ACGT', CAST((p_partkey + 1 + (p_partkey // 4) % 3) % 4 AS INTEGER) + 1, 1) AS alt, "
        "p_size > 5 AS high_quality FROM part"),
    "fx_sample": (
        "SELECT c_custkey AS user_id, CAST(c_custkey AS VARCHAR) AS s, "
        f"{case_index('c_nationkey % 6', POPS)} AS pop, "
        "c_custkey % 10 <> 0 AS in_qc_list, c_custkey % 37 = 0 AS withdrawn FROM customer"),
    "fx_dosage": (
        "SELECT o_custkey AS user_id, vid, CAST(max(CAST(l_quantity AS INTEGER) % 3) AS DOUBLE) AS dosage "
        "FROM (SELECT l_orderkey, l_partkey AS vid, l_quantity FROM lineitem UNION ALL "
        "SELECT l_orderkey, l_partkey - 22, l_quantity FROM lineitem "
        "WHERE (l_partkey // 22) % 4 <> 0 AND l_orderkey % 4 <> 0) l "
        "JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, vid"),
    "fx_stat": (
        "SELECT pid, vid, pop, CAST(beta_c AS DOUBLE) AS beta, (10 + n) / 1e1 AS se, p, n, "
        "(1 + (vid * 31 + pid * 7) % 98) / 1e2 AS af, "
        "(1 + (vid * 17 + pid * 3) % 98) / 1e2 AS af_cases, "
        "(1 + (vid * 13 + pid * 11) % 98) / 1e2 AS af_controls, "
        "CASE WHEN (pid + vid) % 17 = 0 THEN NULL ELSE (pid + vid) % 13 = 0 END AS low_confidence "
        "FROM (SELECT l_suppkey AS pid, l_partkey AS vid, "
        f"{case_index('c_nationkey % 6', POPS)} AS pop, "
        "CAST(sum(CAST(round(l_discount * 100) AS BIGINT) - 5) AS BIGINT) AS beta_c, count(*) AS n, "
        "min((1 + (l_orderkey * 7919 + l_partkey * 104729) % 999) / "
        f"{p_denominator('(l_orderkey + l_suppkey) % 9')}) AS p "
        "FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey "
        "GROUP BY 1, 2, 3) g"),
    "fx_pheno": (
        f"SELECT s_suppkey AS pid, {case_index('s_suppkey % 6', TRAIT_TYPES)} AS trait_type, "
        "CAST(20000 + s_suppkey AS VARCHAR) AS phenocode, 'both_sexes' AS pheno_sex, "
        "CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE 'c ' || CAST(s_nationkey AS VARCHAR) || '/x' END AS coding, "
        "CASE WHEN s_suppkey % 6 = 0 THEN 'irnt' ELSE '' END AS modifier FROM supplier"),
    "fx_pheno_pop": (
        "SELECT pid, pop, pop_ix, 50 + (pid * 13 + pop_ix * 7) % 500 AS n_cases, "
        "1000 + (pid * 29 + pop_ix * 3) % 9000 AS n_controls, "
        "((pid * 7 + pop_ix * 11) % 17 + 4) / 1e1 AS lambda_gc, "
        "((pid * 3 + pop_ix * 5) % 50) / 1e2 AS heritability "
        "FROM fx_pheno CROSS JOIN fx_pops "
        "WHERE pid % 4 = 0 OR 4 * pop_ix + 1 = pid % 24 OR (pid % 4 > 1 AND (pid + pop_ix) % 6 <> 0)"),
    "fx_num_pops": "SELECT pid, count(*) AS num_pops FROM fx_pheno_pop GROUP BY pid",
    "fx_sumstats": "SELECT * FROM fx_stat WHERE (pid, pop) IN (SELECT pid, pop FROM fx_pheno_pop)",
    "fx_min": "SELECT pid, vid, sum(beta) AS beta, min(p) AS p FROM fx_stat GROUP BY pid, vid",
    "fx_meta_member": (
        "SELECT pp.pid, 0 AS meta_ix, pp.pop FROM fx_pheno_pop pp JOIN fx_num_pops n ON pp.pid = n.pid "
        "WHERE n.num_pops > 1 "
        "UNION ALL SELECT pp.pid, x.pop_ix + 1 AS meta_ix, pp.pop FROM fx_pheno_pop pp "
        "JOIN fx_num_pops n ON pp.pid = n.pid JOIN fx_pops x ON pp.pop <> x.pop WHERE n.num_pops = 6"),
    "fx_meta_data": (
        "SELECT pid, meta_ix, array_to_string(list_sort(list(pop)), ',') AS pops_str "
        "FROM fx_meta_member GROUP BY pid, meta_ix"),
    "fx_meta": (
        "SELECT s.pid, s.vid, m.meta_ix, sum(s.beta) AS beta, min(s.se) AS se, min(s.p) AS p, "
        "max(s.p) AS p_het, CAST(sum(s.n) AS BIGINT) AS n, max(s.af) AS af, max(s.af_cases) AS af_cases, "
        "max(s.af_controls) AS af_controls "
        "FROM fx_sumstats s JOIN fx_meta_member m ON s.pid = m.pid AND s.pop = m.pop "
        "GROUP BY s.pid, s.vid, m.meta_ix"),
    "fx_own_pops": (
        "SELECT pid, array_to_string(list_sort(list(pop)), ',') AS own_pops_str FROM fx_pheno_pop GROUP BY pid"),
    "fx_clump": (
        "SELECT *, NSIG + S05 + S01 + S001 + S0001 AS TOTAL FROM (SELECT m.pid, m.vid, o.own_pops_str AS clump_pops_str, "
        "m.p AS P, CAST(m.vid % 5 AS INTEGER) AS NSIG, CAST((m.vid + m.pid) % 4 AS INTEGER) AS S05, "
        "CAST(m.pid % 3 AS INTEGER) AS S01, CAST(m.vid % 2 AS INTEGER) AS S001, "
        "CAST((m.vid * m.pid) % 3 AS INTEGER) AS S0001 "
        "FROM fx_min m JOIN fx_own_pops o ON m.pid = o.pid) c"),
    "fx_h2": "SELECT phenocode AS phenotype, ((pid * 7) % 50) / 1e1 AS h2_z FROM fx_pheno",
    "fx_gene": (
        "SELECT CAST(1 + n_nationkey % 22 AS VARCHAR) AS chrom, "
        "CAST((n_nationkey * 37 % 90) * 20000 AS INTEGER) AS start_pos, "
        "CAST((n_nationkey * 37 % 90) * 20000 + 100000 AS INTEGER) AS end_pos, "
        "'G' || CAST(n_nationkey AS VARCHAR) AS gene_name FROM nation"),
    "fx_phenotype": (
        "SELECT s.user_id, p.pid, p.trait_type, p.phenocode, p.pheno_sex, p.coding, p.modifier, "
        "CASE WHEN (s.user_id + p.pid) % 11 = 0 THEN NULL "
        "WHEN (s.user_id * 31 + p.pid * 17) % 5 = 0 THEN 1 ELSE 0 END AS both_sexes "
        "FROM fx_sample s CROSS JOIN fx_pheno p"),
}
FX_SQL["fx_thresholds"] = f"SELECT * FROM (VALUES {_thresholds_values()}) AS t(t_ix, p_threshold_name, p_threshold)"

_FX_RE = re.compile(r"\bfx_[a-z0-9_]+\b")


def _deps(sql: str) -> list[str]:
    return [m for m in dict.fromkeys(_FX_RE.findall(sql)) if m in FX_SQL]


def with_fx(body: str) -> str:
    """Prepend the CTEs of every fixture view the body (transitively) uses."""
    order: list[str] = []

    def visit(name: str, stack: tuple = ()):
        if name in order:
            return
        for d in _deps(FX_SQL[name]):
            if d != name and d not in stack:
                visit(d, stack + (name,))
        order.append(name)

    for n in _deps(body):
        visit(n)
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS ({FX_SQL[n]})" for n in order)
    stripped = body.lstrip()
    if stripped[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {ctes},\n{stripped[15:]}"
    if stripped[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{stripped[5:]}"
    return f"WITH {ctes}\n{body}"
