"""Reshapes, joins, aggregations, windows and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from polyscore.functions import ids
from polyscore.operators import joins as jn
from polyscore.operators import reshape as rs
from polyscore.operators import window as wn
from polyscore.plans import prs
from polyscore.queries.q_basic import PHENO_ID_SQL, VARID_SQL
from polyscore.queries.registry import register
from polyscore.sources.fixtures import Fixtures

STAT_FIELDS = ["af", "af_cases", "af_controls", "beta", "se", "p", "low_confidence"]


def array_form(fx: Fixtures):
    cols = rs.pheno_data_arrays(fx.pheno_pop)
    entries = rs.summary_stat_arrays(fx.sumstats, cols, STAT_FIELDS)
    return cols, entries


# ---------------------------------------------------------------- reshape

@register("separate_by_pop", """
WITH e AS (SELECT DISTINCT pid, vid FROM fx_sumstats),
pp AS (SELECT pid, pop, CAST(row_number() OVER (PARTITION BY pid ORDER BY pop) - 1 AS INTEGER) AS pop_index
       FROM fx_pheno_pop)
SELECT e.pid, e.vid, pp.pop_index, pp.pop, s.beta, s.p
FROM e JOIN pp ON e.pid = pp.pid LEFT JOIN fx_sumstats s ON s.pid = e.pid AND s.vid = e.vid AND s.pop = pp.pop""")
def separate_by_pop(spark, sf):
    cols, entries = array_form(Fixtures(spark, sf))
    out = rs.separate_by_pop(cols, entries, keep_index=True)
    return out.select("pid", "vid", "pop_index", F.col("pheno_data.pop").alias("pop"),
                      F.col("summary_stats.beta").alias("beta"), F.col("summary_stats.p").alias("p"))


@register("explode_thresholds", """
SELECT o.pid, o.own_pops_str AS clump_pops_str, t.p_threshold_name, t.p_threshold
FROM fx_own_pops o CROSS JOIN fx_thresholds t""")
def explode_thresholds(spark, sf):
    fx = Fixtures(spark, sf)
    return rs.explode_thresholds(fx.own_pops.select("pid", F.col("own_pops_str").alias("clump_pops_str")))


@register("collect_by_key", """
SELECT m.pid, m.vid, string_agg(d.pops_str, ';' ORDER BY d.pops_str) AS clump_pops, CAST(count(*) AS INTEGER) AS n_sets,
  min(m.p) AS best_p
FROM fx_meta m JOIN fx_meta_data d ON m.pid = d.pid AND m.meta_ix = d.meta_ix GROUP BY m.pid, m.vid""")
def collect_by_key(spark, sf):
    fx = Fixtures(spark, sf)
    m = fx.meta.join(fx.meta_data.select("pid", "meta_ix", "pops_str"), ["pid", "meta_ix"])
    g = m.groupBy("pid", "vid").agg(F.array_sort(F.collect_list(F.struct("pops_str", "p"))).alias("cols"))
    return g.select("pid", "vid", F.array_join(F.col("cols.pops_str"), ";").alias("clump_pops"),
                    F.size("cols").alias("n_sets"), F.array_min(F.col("cols.p")).alias("best_p"))


@register("to_matrix", """
SELECT DISTINCT s.pid, ph.trait_type, ph.phenocode FROM fx_min s JOIN fx_pheno ph ON s.pid = ph.pid""")
def to_matrix(spark, sf):
    return _matrix_parts(spark, sf)[1]


@register("to_matrix_rows", """
SELECT DISTINCT v.vid, v.chrom, v.pos FROM fx_min s JOIN fx_pheno ph ON s.pid = ph.pid JOIN fx_variant v ON v.vid = s.vid""")
def to_matrix_rows(spark, sf):
    return _matrix_parts(spark, sf)[0]


@register("to_matrix_entries", """
SELECT s.vid, s.pid, s.beta, s.p FROM fx_min s JOIN fx_pheno ph ON s.pid = ph.pid JOIN fx_variant v ON v.vid = s.vid""")
def to_matrix_entries(spark, sf):
    return _matrix_parts(spark, sf)[2]


def _matrix_parts(spark, sf):
    fx = Fixtures(spark, sf)
    flat = fx.min_stat.join(fx.pheno, "pid").join(fx.variant, "vid")
    return rs.to_matrix(flat, ["vid"], ["pid"], ["chrom", "pos"], ["trait_type", "phenocode"], ["beta", "p"])


@register("axis_index", """
SELECT vid, row_number() OVER (ORDER BY chrom, pos) - 1 AS idx FROM fx_variant""")
def axis_index(spark, sf):
    fx = Fixtures(spark, sf)
    return rs.add_dim_index(fx.variant.select("vid", "chrom", "pos"), ["chrom", "pos"]).select("vid", "idx")


@register("munge_clump", """
SELECT pid, vid, own_pops_str AS clump_pops_str, TOTAL, P, 0 AS pop_index
FROM fx_clump c JOIN fx_own_pops o USING (pid)""")
def munge_clump(spark, sf):
    from polyscore.plans.clumping import munge_clump as munge
    fx = Fixtures(spark, sf)
    m = munge(fx.clump.drop("clump_pops_str"), fx.own_pops.withColumnRenamed("own_pops_str", "clump_pops_str"))
    return m.select("pid", "vid", "clump_pops_str", F.col("plink_clump.TOTAL").alias("TOTAL"),
                    F.col("plink_clump.P").alias("P"), "pop_index")


# ---------------------------------------------------------------- joins

@register("annotate_variant_qc", """
SELECT s.pid, s.vid, s.pop, v.high_quality FROM fx_sumstats s LEFT JOIN fx_variant v ON s.vid = v.vid""")
def annotate_variant_qc(spark, sf):
    fx = Fixtures(spark, sf)
    return fx.sumstats.select("pid", "vid", "pop").join(fx.variant.select("vid", "high_quality"), "vid", "left")


@register("annotate_entries", """
SELECT s.pid, s.vid, s.pop, s.beta, m.beta AS beta_meta, m.p AS pval_meta
FROM fx_sumstats s LEFT JOIN fx_meta m ON s.pid = m.pid AND s.vid = m.vid AND m.meta_ix = 0""")
def annotate_entries(spark, sf):
    fx = Fixtures(spark, sf)
    m = fx.meta.where("meta_ix = 0").select("pid", "vid", F.col("beta").alias("beta_meta"),
                                            F.col("p").alias("pval_meta"))
    return fx.sumstats.select("pid", "vid", "pop", "beta").join(m, ["pid", "vid"], "left")


@register("semi_variants", """
SELECT user_id, vid, dosage FROM fx_dosage WHERE vid IN (SELECT vid FROM fx_min WHERE p < 1e-4)""")
def semi_variants(spark, sf):
    fx = Fixtures(spark, sf)
    return fx.dosage.join(fx.min_stat.where("p < 1e-4").select("vid"), "vid", "left_semi")


@register("hq_samples", """
SELECT user_id, s FROM fx_sample WHERE user_id NOT IN (SELECT user_id FROM fx_sample WHERE withdrawn)""")
def hq_samples(spark, sf):
    fx = Fixtures(spark, sf)
    withdrawn = fx.sample.where("withdrawn").select("user_id")
    return fx.sample.select("user_id", "s").join(withdrawn, "user_id", "left_anti")


@register("cohort", """
SELECT c.user_id, c.pop FROM fx_sample c
WHERE c.user_id IN (SELECT user_id FROM fx_sample WHERE in_qc_list)
  AND c.user_id NOT IN (SELECT user_id FROM fx_sample WHERE withdrawn) AND c.pop = 'EUR'""")
def cohort(spark, sf):
    from polyscore.plans.cohort import cohort as build
    fx = Fixtures(spark, sf)
    return build(fx.sample.select("user_id", "pop"), fx.sample.where("in_qc_list").select("user_id"),
                 fx.sample.where("withdrawn").select("user_id"), pop="EUR")


@register("stats_clump_join", """
SELECT m.pid, m.vid, d.pops_str AS clump_pops_str, m.beta, m.p, c.TOTAL
FROM fx_meta m JOIN fx_meta_data d ON m.pid = d.pid AND m.meta_ix = d.meta_ix
JOIN fx_clump c ON c.pid = m.pid AND c.vid = m.vid AND c.clump_pops_str = d.pops_str""")
def stats_clump_join(spark, sf):
    fx = Fixtures(spark, sf)
    m = fx.meta.join(fx.meta_data.select("pid", "meta_ix", F.col("pops_str").alias("clump_pops_str")),
                     ["pid", "meta_ix"])
    return m.join(fx.clump.select("pid", "vid", "clump_pops_str", "TOTAL"), ["pid", "vid", "clump_pops_str"]) \
        .select("pid", "vid", "clump_pops_str", "beta", "p", "TOTAL")


@register("union_cols_inner", """
WITH a AS (SELECT pid, vid, 'meta' AS col, beta FROM fx_meta WHERE meta_ix = 0),
b AS (SELECT pid, vid, 'EUR' AS col, beta FROM fx_sumstats WHERE pop = 'EUR'),
shared AS (SELECT vid FROM a INTERSECT SELECT vid FROM b)
SELECT * FROM a WHERE vid IN (SELECT vid FROM shared) UNION ALL SELECT * FROM b WHERE vid IN (SELECT vid FROM shared)""")
def union_cols_inner(spark, sf):
    fx = Fixtures(spark, sf)
    a = fx.meta.where("meta_ix = 0").select("pid", "vid", F.lit("meta").alias("col"), "beta")
    b = fx.sumstats.where("pop = 'EUR'").select("pid", "vid", F.lit("EUR").alias("col"), "beta")
    return jn.union_cols_inner(a, b, ["vid"])


@register("union_cols_all", """
WITH a AS (SELECT m.pid, m.vid, d.pops_str AS col, m.beta, m.p FROM fx_meta m
  JOIN fx_meta_data d ON m.pid = d.pid AND m.meta_ix = d.meta_ix),
b AS (SELECT pid, vid, pop AS col, beta, p FROM fx_sumstats),
shared AS (SELECT vid FROM a INTERSECT SELECT vid FROM b)
SELECT * FROM a WHERE vid IN (SELECT vid FROM shared) UNION ALL SELECT * FROM b WHERE vid IN (SELECT vid FROM shared)""")
def union_cols_all(spark, sf):
    """Columns of every meta-analysis set beside those of every population, on the variants that both have."""
    fx = Fixtures(spark, sf)
    a = fx.meta.join(fx.meta_data.select("pid", "meta_ix", F.col("pops_str").alias("col")), ["pid", "meta_ix"]) \
        .select("pid", "vid", "col", "beta", "p")
    return jn.union_cols_inner(a, fx.sumstats.select("pid", "vid", F.col("pop").alias("col"), "beta", "p"), ["vid"])


@register("union_cols_outer", """
SELECT m.pid, m.vid, d.pops_str AS clump_pops_str, m.p FROM fx_meta m
JOIN fx_meta_data d ON m.pid = d.pid AND m.meta_ix = d.meta_ix""")
def union_cols_outer(spark, sf):
    fx = Fixtures(spark, sf)
    parts = [fx.meta.where(F.col("meta_ix") == k).join(fx.meta_data.select("pid", "meta_ix", "pops_str"),
                                                      ["pid", "meta_ix"])
             .select("pid", "vid", F.col("pops_str").alias("clump_pops_str"), "p") for k in range(7)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("union_rows", """
SELECT d.user_id, d.vid, d.dosage FROM fx_dosage d""")
def union_rows(spark, sf):
    fx = Fixtures(spark, sf)
    v = fx.variant.select("vid", "chrom")
    auto = fx.dosage.join(v.where("chrom <> '22'"), "vid", "left_semi")
    x = fx.dosage.join(v.where("chrom = '22'"), "vid", "left_semi")
    return auto.unionByName(x).select("user_id", "vid", "dosage")


@register("multiway_zip", """
SELECT pid, vid, """ + ", ".join(f"max(CASE WHEN meta_ix = {k} THEN p END) AS p{k}" for k in range(7)) + """,
  CAST(count(*) AS INTEGER) AS n_present
FROM fx_meta GROUP BY pid, vid""")
def multiway_zip(spark, sf):
    fx = Fixtures(spark, sf)
    tables = [fx.meta.where(F.col("meta_ix") == k).select("pid", "vid", F.col("p").alias("value")) for k in range(7)]
    z = jn.zip_join(tables, ["pid", "vid"])
    return z.select("pid", "vid", *[F.get("values", k).alias(f"p{k}") for k in range(7)],
                    F.size(F.filter("values", lambda x: x.isNotNull())).alias("n_present"))


@register("gene_overlap", """
SELECT v.vid, coalesce(string_agg(g.gene_name, ',' ORDER BY g.gene_name), '') AS nearest_genes
FROM fx_variant v LEFT JOIN fx_gene g ON v.chrom = g.chrom AND v.pos >= g.start_pos AND v.pos < g.end_pos
GROUP BY v.vid""")
def gene_overlap(spark, sf):
    fx = Fixtures(spark, sf)
    return jn.genes_containing(fx.variant.select("vid", "chrom", "pos"), fx.gene, as_string=True) \
        .select("vid", "nearest_genes")


def _allele_file(fx):
    """A bim-like allele file: alleles swapped on every third row, a shifted position on every 11th."""
    v = fx.variant
    return v.select(F.col("vid").alias("idx"), "chrom",
                    F.when(F.col("vid") % 11 == 0, F.col("pos") + 1).otherwise(F.col("pos")).alias("pos"),
                    F.when(F.col("vid") % 3 == 0, F.col("alt")).otherwise(F.col("ref")).alias("a1"),
                    F.when(F.col("vid") % 3 == 0, F.col("ref")).otherwise(F.col("alt")).alias("a2"))


@register("fix_alleles", f"""
WITH f AS (SELECT vid AS idx, chrom, CASE WHEN vid % 11 = 0 THEN pos + 1 ELSE pos END AS pos,
  CASE WHEN vid % 3 = 0 THEN alt ELSE ref END AS a1, CASE WHEN vid % 3 = 0 THEN ref ELSE alt END AS a2 FROM fx_variant)
SELECT f.idx, f.chrom, f.pos, f.a1 AS A1_bim, f.a2 AS A2_bim,
  CASE WHEN v.vid IS NULL THEN NULL ELSE {VARID_SQL.replace('chrom', 'v.chrom').replace('CAST(pos', 'CAST(v.pos').replace('ref', 'v.ref').replace('alt', 'v.alt')} END AS SNP
FROM f LEFT JOIN fx_variant v ON f.chrom = v.chrom AND f.pos = v.pos AND least(f.a1, f.a2) = least(v.ref, v.alt)
  AND greatest(f.a1, f.a2) = greatest(v.ref, v.alt)""")
def fix_alleles(spark, sf):
    from polyscore.plans.cohort import fix_alleles as fix
    fx = Fixtures(spark, sf)
    return fix(_allele_file(fx), fx.variant.select("chrom", "pos", "ref", "alt"))


@register("manifest_pairs", f"""
WITH m AS (SELECT {PHENO_ID_SQL} || '.tsv.bgz' AS File, 1000 + pid * 7 AS size FROM fx_pheno
  UNION ALL SELECT {PHENO_ID_SQL} || '.tsv.bgz.tbi' AS File, 10 + pid AS size FROM fx_pheno)
SELECT d.File, d.size, i.File AS File_tabix, i.size AS size_tabix
FROM m d JOIN m i ON d.File = replace(i.File, '.tbi', '') WHERE i.File LIKE '%.tbi' AND d.File NOT LIKE '%.tbi'""")
def manifest_pairs(spark, sf):
    from polyscore.plans.export import manifest_pairs as pairs
    fx = Fixtures(spark, sf)
    pid_ = ids.pheno_id()
    m = (fx.pheno.select(F.concat(pid_, F.lit(".tsv.bgz")).alias("File"), (F.lit(1000) + F.col("pid") * 7).alias("size"))
         .unionByName(fx.pheno.select(F.concat(pid_, F.lit(".tsv.bgz.tbi")).alias("File"),
                                      (F.lit(10) + F.col("pid")).alias("size"))))
    return pairs(m)


# ---------------------------------------------------------------- aggregations

@register("prs_direct", """
SELECT d.user_id, m.pid, sum(m.beta * d.dosage) AS score
FROM fx_meta m JOIN fx_clump c ON m.pid = c.pid AND m.vid = c.vid JOIN fx_dosage d ON d.vid = m.vid
WHERE m.meta_ix = 0 GROUP BY d.user_id, m.pid""")
def prs_direct(spark, sf):
    from polyscore.operators.score import score
    fx = Fixtures(spark, sf)
    w = fx.meta.where("meta_ix = 0").join(fx.clump.select("pid", "vid"), ["pid", "vid"], "left_semi")
    return score(w.select("pid", "vid", "beta"), fx.dosage, ["pid"])


_WEIGHTS_SQL = """
WITH cols AS (
  SELECT m.pid, d.pops_str AS clump_pops_str, m.vid, m.beta AS BETA, m.p AS Pvalue, 0 AS source FROM fx_meta m
  JOIN fx_meta_data d ON m.pid = d.pid AND m.meta_ix = d.meta_ix
  UNION ALL SELECT pid, pop, vid, beta, p, 1 FROM fx_sumstats),
keep AS (SELECT pid, clump_pops_str, min(source) AS source FROM (SELECT DISTINCT pid, clump_pops_str, source FROM cols)
  GROUP BY pid, clump_pops_str),
w AS (SELECT c.pid, c.clump_pops_str, c.vid, coalesce(c.BETA, s.beta) AS beta, coalesce(c.Pvalue, s.p) AS p FROM cols c
  JOIN keep k ON c.pid = k.pid AND c.clump_pops_str = k.clump_pops_str AND c.source = k.source
  JOIN fx_clump cl ON cl.pid = c.pid AND cl.vid = c.vid AND cl.clump_pops_str = c.clump_pops_str
  LEFT JOIN fx_sumstats s ON s.pid = c.pid AND s.vid = c.vid AND s.pop = c.clump_pops_str)
"""


@register("prs_weights", _WEIGHTS_SQL + "SELECT * FROM w")
def prs_weights(spark, sf):
    fx = Fixtures(spark, sf)
    return prs.prs_weights(fx.meta, fx.meta_data, fx.sumstats, fx.clump, fx.pheno_pop)


@register("prs_clumped", _WEIGHTS_SQL + """
SELECT d.user_id, w.pid, w.clump_pops_str, t.p_threshold_name, t.p_threshold, sum(w.beta * d.dosage) AS score
FROM w JOIN fx_dosage d ON w.vid = d.vid JOIN fx_thresholds t ON w.p < t.p_threshold
GROUP BY d.user_id, w.pid, w.clump_pops_str, t.p_threshold_name, t.p_threshold""")
def prs_clumped(spark, sf):
    fx = Fixtures(spark, sf)
    return prs.prs_scores(prs.prs_weights(fx.meta, fx.meta_data, fx.sumstats, fx.clump, fx.pheno_pop), fx.dosage)


@register("weight_qc", """
SELECT pid, count(*) AS n_weights, count(*) FILTER (WHERE isnan(beta)) AS n_nan_beta,
  count(*) FILTER (WHERE beta IS NULL) AS n_missing_beta, count(*) FILTER (WHERE p IS NULL OR isnan(p)) AS n_missing_p
FROM fx_min GROUP BY pid""")
def weight_qc(spark, sf):
    from polyscore.operators.score import weight_qc as qc
    return qc(Fixtures(spark, sf).min_stat, ["pid"])


@register("matrix_dims", """
SELECT count(DISTINCT vid) AS n_rows, count(DISTINCT pid) AS n_cols, count(*) AS n_entries,
  count(DISTINCT pid || ':' || pop) AS n_pheno_pops FROM fx_sumstats""")
def matrix_dims(spark, sf):
    fx = Fixtures(spark, sf)
    return fx.sumstats.agg(F.countDistinct("vid").alias("n_rows"), F.countDistinct("pid").alias("n_cols"),
                           F.count(F.lit(1)).alias("n_entries"),
                           F.countDistinct("pid", "pop").alias("n_pheno_pops"))


@register("distinct_by_col", """
WITH c AS (SELECT DISTINCT m.pid, d.pops_str AS clump_pops_str, 0 AS source FROM fx_meta_data d JOIN fx_meta m
  ON m.pid = d.pid AND m.meta_ix = d.meta_ix
  UNION ALL SELECT DISTINCT pid, pop, 1 FROM fx_sumstats
  UNION ALL SELECT DISTINCT pid, own_pops_str, 1 FROM fx_own_pops)
SELECT pid, clump_pops_str, min(source) AS source FROM c GROUP BY pid, clump_pops_str""")
def distinct_by_col(spark, sf):
    fx = Fixtures(spark, sf)
    dim = prs.column_dimension(fx.meta_data, fx.pheno_pop).unionByName(
        fx.own_pops.select("pid", F.col("own_pops_str").alias("clump_pops_str"), F.lit(1).alias("source")))
    return prs.distinct_columns(dim, dim).distinct()


@register("coalesce_stats", """
WITH a AS (SELECT pid, vid, pop, CASE WHEN low_confidence THEN NULL ELSE beta END AS BETA,
   CASE WHEN (pid + vid) % 7 = 0 THEN NULL ELSE p END AS Pvalue FROM fx_sumstats)
SELECT a.pid, a.vid, a.pop, coalesce(a.BETA, s.beta) AS BETA, coalesce(a.Pvalue, s.p) AS Pvalue
FROM a LEFT JOIN fx_sumstats s ON a.pid = s.pid AND a.vid = s.vid AND a.pop = s.pop""")
def coalesce_stats(spark, sf):
    fx = Fixtures(spark, sf)
    holes = fx.sumstats.select("pid", "vid", F.col("pop").alias("clump_pops_str"),
                               F.when(F.col("low_confidence"), None).otherwise(F.col("beta")).alias("BETA"),
                               F.when((F.col("pid") + F.col("vid")) % 7 == 0, None).otherwise(F.col("p")).alias("Pvalue"))
    single = fx.sumstats.select("pid", "vid", F.col("pop").alias("clump_pops_str"), F.col("beta").alias("BETA"),
                                F.col("p").alias("Pvalue"))
    return prs.coalesce_from(holes, single).withColumnRenamed("clump_pops_str", "pop")


@register("pop_sets", """
SELECT DISTINCT pops FROM (SELECT array_to_string(list_sort(list(pop)), ',') AS pops FROM fx_pheno_pop GROUP BY pid)""")
def pop_sets(spark, sf):
    fx = Fixtures(spark, sf)
    return fx.own_pops.select(F.col("own_pops_str").alias("pops")).distinct().orderBy("pops")


@register("pop_proportions", """
SELECT pop, count(*) AS n, count(*) / sum(count(*)) OVER () AS proportion FROM fx_sample GROUP BY pop""")
def pop_proportions(spark, sf):
    from polyscore.plans.subset import pop_proportions as props
    return props(Fixtures(spark, sf).sample)


# ---------------------------------------------------------------- windows

@register("rank_by_p", """
SELECT pid, vid, P, row_number() OVER (PARTITION BY pid ORDER BY P, chrom, pos) - 1 AS idx
FROM (SELECT c.pid, c.vid, c.P, v.chrom, v.pos FROM fx_clump c JOIN fx_variant v ON c.vid = v.vid)""")
def rank_by_p(spark, sf):
    fx = Fixtures(spark, sf)
    c = fx.clump.select("pid", "vid", "P").join(fx.variant.select("vid", "chrom", "pos"), "vid")
    return wn.rank_within(c, ["pid"], ["P", "chrom", "pos"]).select("pid", "vid", "P", "idx")


@register("first_samples", """
SELECT user_id, s FROM fx_sample ORDER BY user_id LIMIT 10""")
def first_samples(spark, sf):
    fx = Fixtures(spark, sf)
    return fx.sample.select("user_id", "s").orderBy("user_id").limit(10)


@register("sample_size", """
SELECT o.pops, least(count(*), 5000) AS n_subset
FROM (SELECT DISTINCT own_pops_str AS pops FROM fx_own_pops) o
JOIN fx_sample s ON list_contains(string_split(o.pops, ','), s.pop) GROUP BY o.pops""")
def sample_size(spark, sf):
    from polyscore.plans.subset import sample_sizes
    fx = Fixtures(spark, sf)
    return sample_sizes(fx.sample, fx.own_pops.select(F.col("own_pops_str").alias("pops")).distinct())


# ---------------------------------------------------------------- set operations

@register("union_tables", """
SELECT pid, user_id, 'case' AS status FROM fx_phenotype WHERE both_sexes = 1
UNION ALL SELECT pid, user_id, 'control' AS status FROM fx_phenotype WHERE both_sexes = 0""")
def union_tables(spark, sf):
    fx = Fixtures(spark, sf)
    ph = fx.phenotype
    cases = ph.where("both_sexes = 1").select("pid", "user_id", F.lit("case").alias("status"))
    controls = ph.where("both_sexes = 0").select("pid", "user_id", F.lit("control").alias("status"))
    return cases.unionByName(controls)




@register("densify", """
SELECT m.pid, m.vid, t.p_threshold_name, t.p_threshold,
  CASE WHEN m.beta IS NOT NULL AND NOT isnan(m.beta) AND m.p < t.p_threshold THEN m.beta ELSE 0.0 END AS weight
FROM fx_min m CROSS JOIN fx_thresholds t""")
def densify(spark, sf):
    fx = Fixtures(spark, sf)
    return rs.densify_thresholds(fx.min_stat).select("pid", "vid", "p_threshold_name", "p_threshold", "weight")


@register("full_clump", """
WITH u AS (SELECT pid, vid, clump_pops_str, TOTAL FROM fx_clump
  UNION ALL SELECT pid, vid, pop AS clump_pops_str, CAST(vid % 5 AS INTEGER) AS TOTAL FROM fx_sumstats)
SELECT pid, vid, string_agg(clump_pops_str, ';' ORDER BY clump_pops_str) AS clump_pops, CAST(count(*) AS INTEGER) AS n_sets,
  CAST(sum(TOTAL) AS BIGINT) AS sum_total
FROM u GROUP BY pid, vid""")
def full_clump(spark, sf):
    from polyscore.plans.clumping import full_clump as build
    fx = Fixtures(spark, sf)
    single = (fx.sumstats
              .select("pid", "vid", F.col("pop").alias("clump_pops_str"), F.expr("CAST(vid % 5 AS INT)").alias("TOTAL")))
    own = fx.clump.select("pid", "vid", "clump_pops_str", "TOTAL")
    return build([own, single])


@register("prs_labeled", _WEIGHTS_SQL.rstrip() + """,
sc AS (SELECT d.user_id, w.pid, w.clump_pops_str, t.p_threshold_name, t.p_threshold, sum(w.beta * d.dosage) AS score
  FROM w JOIN fx_dosage d ON w.vid = d.vid JOIN fx_thresholds t ON w.p < t.p_threshold GROUP BY 1, 2, 3, 4, 5)
SELECT sc.user_id, ph.trait_type, ph.phenocode, ph.pheno_sex, ph.coding, ph.modifier, sc.clump_pops_str,
  sc.p_threshold_name, sc.p_threshold, sc.score
FROM sc JOIN fx_pheno ph ON sc.pid = ph.pid""")
def prs_labeled(spark, sf):
    """Scores keyed by user and the five-field phenotype key (the study's final score matrix, long form)."""
    fx = Fixtures(spark, sf)
    s = prs.prs_scores(prs.prs_weights(fx.meta, fx.meta_data, fx.sumstats, fx.clump, fx.pheno_pop), fx.dosage)
    return prs.label_scores(s, fx.pheno).select("user_id", "trait_type", "phenocode", "pheno_sex", "coding",
                                                "modifier", "clump_pops_str", "p_threshold_name", "p_threshold",
                                                "score")


@register("filtered_genotypes", """
WITH vc AS (SELECT vid, pop, max(af) AS af, CAST(2 * sum(n) AS BIGINT) AS an FROM fx_sumstats GROUP BY vid, pop),
ok AS (SELECT DISTINCT vid FROM vc WHERE af * an >= 20),
coh AS (SELECT user_id FROM fx_sample WHERE in_qc_list AND NOT withdrawn)
SELECT d.user_id, d.vid, d.dosage FROM fx_dosage d
WHERE d.vid IN (SELECT vid FROM ok) AND d.user_id IN (SELECT user_id FROM coh) AND d.vid IN (SELECT vid FROM fx_meta)""")
def filtered_genotypes(spark, sf):
    """Genotype preparation for scores: allele-count filter, cohort samples, analysed variants only."""
    from polyscore.plans.cohort import cohort as build_cohort
    from polyscore.plans.cohort import filtered_genotypes as build
    from polyscore.queries.q_basic import _af_an_maps
    fx = Fixtures(spark, sf)
    coh = build_cohort(fx.sample.select("user_id", "pop"), fx.sample.where("in_qc_list").select("user_id"),
                       fx.sample.where("withdrawn").select("user_id"))
    return build(fx.dosage, _af_an_maps(fx), coh, fx.meta).select("user_id", "vid", "dosage")


@register("varid_listing", f"""
WITH vc AS (SELECT vid, pop, max(af) AS af, CAST(2 * sum(n) AS BIGINT) AS an FROM fx_sumstats GROUP BY vid, pop)
SELECT v.chrom, v.pos, {VARID_SQL.replace('chrom', 'v.chrom').replace('CAST(pos', 'CAST(v.pos').replace('ref', 'v.ref').replace('alt', 'v.alt')} AS varid
FROM fx_variant v WHERE v.vid IN (SELECT vid FROM vc WHERE af * an >= 20)""")
def varid_listing(spark, sf):
    """Variant ids of the genotype data passing the allele-count filter, written space-delimited and read back."""
    from polyscore.functions.ids import variant_id
    from polyscore.operators.filters import min_allele_count
    from polyscore.operators.sinks import write_delimited
    from polyscore.queries.q_basic import _af_an_maps
    from polyscore.session import scratch_path
    fx = Fixtures(spark, sf)
    ok = _af_an_maps(fx).where(min_allele_count("af_map", "an_map")).select("vid")
    rows = fx.variant.join(ok, "vid", "left_semi").select("chrom", "pos", variant_id().alias("varid"))
    path = scratch_path(spark, "varid")
    write_delimited(rows, path, sep=" ")
    return spark.read.schema("chrom string, pos int, varid string").option("sep", " ").option("header", True).csv(path)


@register("coalesce_qc", """
WITH a AS (SELECT pid, pop, CASE WHEN low_confidence THEN NULL ELSE beta END AS BETA,
   CASE WHEN (pid + vid) % 7 = 0 THEN NULL ELSE p END AS Pvalue FROM fx_sumstats)
SELECT pid, pop AS clump_pops_str, count(*) FILTER (WHERE BETA IS NULL) AS n_beta_filled,
  count(*) FILTER (WHERE Pvalue IS NULL) AS n_pvalue_filled,
  count(*) FILTER (WHERE (BETA IS NULL) <> (Pvalue IS NULL)) AS n_mixed_source
FROM a GROUP BY pid, pop""")
def coalesce_qc(spark, sf):
    """Counts behind the independent BETA / Pvalue fill (same holes as ``coalesce_stats``)."""
    fx = Fixtures(spark, sf)
    holes = fx.sumstats.select("pid", F.col("pop").alias("clump_pops_str"),
                               F.when(F.col("low_confidence"), None).otherwise(F.col("beta")).alias("BETA"),
                               F.when((F.col("pid") + F.col("vid")) % 7 == 0, None).otherwise(F.col("p")).alias("Pvalue"))
    return prs.coalesce_qc(holes)
