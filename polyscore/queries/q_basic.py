"""Scans, sinks, projections, filters and scalar functions."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from polyscore.constants import BINARY_TRAIT_TYPES, POPS, QUANT_TRAIT_TYPES
from polyscore.functions import formatting as fmt
from polyscore.functions import ids
from polyscore.functions.arrays import index_of, invalid_values, set_equals
from polyscore.operators import filters as flt
from polyscore.operators import reshape as rs
from polyscore.operators import sinks
from polyscore.queries.registry import register
from polyscore.sources import text
from polyscore.sources.fixtures import Fixtures
from polyscore.sources.genotypes import read_region, write_ranges
from polyscore.sources.staged import staged_path

PHENO_ID_SQL = ("replace(replace(trait_type || '-' || phenocode || '-' || pheno_sex || "
                "CASE WHEN length(coding) > 0 THEN '-' || coding ELSE '' END || "
                "CASE WHEN length(modifier) > 0 THEN '-' || modifier ELSE '' END, ' ', '_'), '/', '_')")
VARID_SQL = "chrom || ':' || CAST(pos AS VARCHAR) || ':' || ref || ':' || alt"


# ---------------------------------------------------------------- sources

@register("matrix_scan", """
SELECT v.vid, v.chrom, v.pos, v.ref, v.alt, s.pid, ph.trait_type, ph.phenocode, s.pop, s.beta, s.p
FROM fx_sumstats s JOIN fx_variant v ON s.vid = v.vid JOIN fx_pheno ph ON s.pid = ph.pid""")
def matrix_scan(spark, sf):
    fx = Fixtures(spark, sf)
    return (fx.sumstats.select("vid", "pid", "pop", "beta", "p")
            .join(fx.variant.select("vid", "chrom", "pos", "ref", "alt"), "vid")
            .join(fx.pheno.select("pid", "trait_type", "phenocode"), "pid"))


@register("covariates_scan", """
SELECT s, TRY_CAST(s AS INTEGER) AS user_id, pop FROM fx_sample WHERE NOT withdrawn""")
def covariates_scan(spark, sf):
    fx = Fixtures(spark, sf)
    return fx.sample.where(~F.col("withdrawn")).select("s", F.col("s").try_cast("int").alias("user_id"), "pop")


def _pheno_pop_tsv(spark, sf):
    fx = Fixtures(spark, sf)
    return staged_path(spark, sf, "pheno_pop_tsv", lambda p: sinks.write_delimited(
        fx.pheno_pop.select("pid", "pop", "n_cases", "n_controls", "lambda_gc"), p))


@register("text_inferred_scan", """
SELECT CAST(pid AS INTEGER) AS pid, pop, CAST(n_cases AS INTEGER) AS n_cases, CAST(n_controls AS INTEGER) AS n_controls,
  lambda_gc FROM fx_pheno_pop""")
def text_inferred_scan(spark, sf):
    return text.read_delimited(spark, _pheno_pop_tsv(spark, sf), infer=True)


def _clump_text_rows(fx: Fixtures):
    """Clump-result text rows per phenotype, and two rows without a contig for each, as blank lines read."""
    v = fx.variant.select("vid", "chrom", "pos", "ref", "alt")
    blank = fx.pheno.select("pid", F.explode(F.array(F.lit(""), F.lit(" "))).alias("chrom"))
    m = (fx.min_stat.select("pid", "vid", "p").join(v, "vid").unionByName(blank, allowMissingColumns=True)
         .repartitionByRange(fx.tasks, "pid", "pos"))  # text is made after the shuffle
    tot = [F.expr("CAST(vid % 5 AS INT)").alias("NSIG"), F.expr("CAST((vid + pid) % 4 AS INT)").alias("S05"),
           F.expr("IF(vid IS NULL, NULL, CAST(pid % 3 AS INT))").alias("S01"), F.expr("CAST(vid % 2 AS INT)").alias("S001"),
           F.expr("CAST((vid * pid) % 3 AS INT)").alias("S0001")]
    return m.select(
        F.col("pid"), F.col("chrom").alias("contig"), F.expr("IF(vid IS NULL, NULL, 1)").alias("F"),
        F.when(F.col("vid").isNotNull(), ids.variant_id()).alias("varid"), "pos", "p", *tot,
    ).selectExpr("pid", "contig", "F", "varid", "pos", "p AS P",
                 "NSIG + S05 + S01 + S001 + S0001 AS TOTAL", "NSIG", "S05", "S01", "S001", "S0001",
                 "CASE WHEN NSIG + S05 + S01 + S001 + S0001 = 0 THEN 'NONE' ELSE varid || '(1)' END AS SP2")


CLUMP_TEXT_SQL = f"""
SELECT m.pid, v.chrom, v.pos, v.ref, v.alt, 1 AS F, m.p AS P,
  CAST(v.vid % 5 + (v.vid + m.pid) % 4 + m.pid % 3 + v.vid % 2 + (v.vid * m.pid) % 3 AS INTEGER) AS TOTAL,
  CAST(v.vid % 5 AS INTEGER) AS NSIG, CAST((v.vid + m.pid) % 4 AS INTEGER) AS S05, CAST(m.pid % 3 AS INTEGER) AS S01,
  CAST(v.vid % 2 AS INTEGER) AS S001, CAST((v.vid * m.pid) % 3 AS INTEGER) AS S0001,
  CASE WHEN v.vid % 5 + (v.vid + m.pid) % 4 + m.pid % 3 + v.vid % 2 + (v.vid * m.pid) % 3 = 0 THEN 'NONE'
       ELSE {VARID_SQL} || '(1)' END AS SP2
FROM fx_min m JOIN fx_variant v ON m.vid = v.vid"""


def _clump_text_path(spark, sf):
    fx = Fixtures(spark, sf)

    def build(p):
        (_clump_text_rows(fx).write.mode("overwrite").partitionBy("pid").option("sep", "\t")
         .option("header", False).option(*sinks.TASKS_COMMIT).csv(p))
    return staged_path(spark, sf, "clump_text", build)


@register("clump_text_scan", CLUMP_TEXT_SQL)
def clump_text_scan(spark, sf):
    df = text.read_clump_text(spark, _clump_text_path(spark, sf))
    return df.select(F.col("pid").cast("bigint").alias("pid"), "chrom", "pos", "ref", "alt", "F", "P", "TOTAL",
                     "NSIG", "S05", "S01", "S001", "S0001", "SP2")


@register("clump_concat", CLUMP_TEXT_SQL)
def clump_concat(spark, sf):
    """Per-chromosome clump outputs read as one dataset (one scan over all parts)."""
    def build(p):
        t = text.read_clump_text(spark, _clump_text_path(spark, sf))
        # a file of a contig per task that its rows fill, not one per group of small text files
        t.repartitionByRange(Fixtures(spark, sf).tasks, "chrom", "pid").write.mode("overwrite").partitionBy("chrom").parquet(p)
    path = staged_path(spark, sf, "clump_by_chrom", build)
    from polyscore.sources.genotypes import read_by_chrom
    return read_by_chrom(spark, path).select(F.col("pid").cast("bigint").alias("pid"), "chrom", "pos", "ref", "alt",
                                           "F", "P", "TOTAL", "NSIG", "S05", "S01", "S001", "S0001", "SP2")


@register("finngen_scan", """
SELECT CAST(v.chrom AS INTEGER) AS "#chrom", v.pos, v.ref, v.alt, m.p AS pval, CAST(m.pid AS INTEGER) AS pid
FROM fx_min m JOIN fx_variant v ON m.vid = v.vid""")
def finngen_scan(spark, sf):
    """Block-gzip text with header (not splittable): read, then spread over partitions."""
    fx = Fixtures(spark, sf)

    def build(p):
        sinks.write_delimited(fx.min_stat.join(fx.variant, "vid").select(
            F.col("chrom").alias("#chrom"), "pos", "ref", "alt", F.col("p").alias("pval"), "pid"), p,
            compression="gzip")
    path = staged_path(spark, sf, "external_gz", build)
    return text.read_delimited(spark, path, schema="`#chrom` int, pos int, ref string, alt string, pval double, pid int",
                               min_partitions=spark.sparkContext.defaultParallelism)


def _genotype_path(spark, sf):
    fx = Fixtures(spark, sf)

    def build(p):
        write_ranges(fx.dosage.join(fx.variant.select("vid", "chrom", "pos"), "vid"), p)
    return staged_path(spark, sf, "genotypes_by_chrom", build)


@register("genotype_scan", """
SELECT d.user_id, d.vid, d.dosage, v.chrom FROM fx_dosage d JOIN fx_variant v ON d.vid = v.vid
WHERE v.chrom IN ('1', '2', '3') AND v.high_quality""")
def genotype_scan(spark, sf):
    from polyscore.sources.genotypes import scan_genotypes
    fx = Fixtures(spark, sf)
    return scan_genotypes(spark, _genotype_path(spark, sf), chroms=["1", "2", "3"],
                          variants=fx.variant.where("high_quality").select("vid"), fields=["dosage"]) \
        .select("user_id", "vid", "dosage", "chrom")


def _stats_by_region_path(spark, sf):
    fx = Fixtures(spark, sf)

    def build(p):
        write_ranges(fx.sumstats.join(fx.variant.select("vid", "chrom", "pos"), "vid"), p)
    return staged_path(spark, sf, "sumstats_by_region", build)


@register("region_query", """
SELECT s.pid, s.vid, s.pop, v.chrom, v.pos, s.p FROM fx_sumstats s JOIN fx_variant v ON s.vid = v.vid
WHERE v.chrom = '5' AND v.pos BETWEEN 100000 AND 900000""")
def region_query(spark, sf):
    return read_region(spark, _stats_by_region_path(spark, sf), "5", 100000, 900000) \
        .select("pid", "vid", "pop", "chrom", "pos", "p")


def _per_pheno_files(spark, sf, withheld: bool = False):
    """One file folder per phenotype (every phenotype; with ``withheld`` every fifth is not yet exported)."""
    fx = Fixtures(spark, sf)

    def build(p):
        src = fx.sumstats.where("pid % 5 <> 0") if withheld else fx.sumstats
        df = src.join(fx.pheno, "pid").select(ids.pheno_id().alias("pheno_id"), "vid", "pop", "beta", "p")
        sinks.write_per_key(df, p, "pheno_id", sort_by=["vid"])
    return staged_path(spark, sf, "per_pheno_partial" if withheld else "per_pheno", build)


@register("manifest_existing", f"""
SELECT ph.pid, {PHENO_ID_SQL} AS pheno_id FROM fx_pheno ph JOIN fx_num_pops n ON ph.pid = n.pid
WHERE n.num_pops = 6 AND ph.pid % 5 <> 0
  AND ph.pid IN (SELECT DISTINCT pid FROM fx_sumstats)""")
def manifest_existing(spark, sf):
    fx = Fixtures(spark, sf)
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", "false")
               .load(_per_pheno_files(spark, sf, withheld=True)).select("path"))
    names = listing.select(F.regexp_extract("path", r"pheno_id=([^/]+)/", 1).alias("pheno_id")).distinct()
    manifest = (fx.pheno.join(fx.num_pops, "pid").where("num_pops = 6")
                .select("pid", ids.pheno_id().alias("pheno_id")))
    return manifest.join(names, "pheno_id", "left_semi")


# ---------------------------------------------------------------- sinks

@register("checkpoint_roundtrip", "SELECT pid, vid, beta, p FROM fx_min")
def checkpoint_roundtrip(spark, sf):
    from polyscore.session import scratch_path
    fx = Fixtures(spark, sf)
    path = scratch_path(spark, "ckpt")
    sinks.materialize(fx.min_stat, path)
    return sinks.materialize(fx.min_stat, path, mode="read_if_exists")


@register("per_pheno_export", f"""
SELECT {PHENO_ID_SQL} AS pheno_id, s.vid, s.pop, s.beta, s.p FROM fx_sumstats s JOIN fx_pheno ph ON s.pid = ph.pid""")
def per_pheno_export(spark, sf):
    df = text.read_delimited(spark, _per_pheno_files(spark, sf), schema="vid bigint, pop string, beta double, p double")
    return df.select("pheno_id", "vid", "pop", "beta", "p")


@register("tsv_export", """
SELECT chrom || ' ' || CAST(pos AS VARCHAR) || ' ' || ref || ' ' || alt AS value FROM fx_variant""")
def tsv_export(spark, sf):
    from polyscore.session import scratch_path
    fx = Fixtures(spark, sf)
    path = scratch_path(spark, "tsv")
    sinks.write_delimited(fx.variant.select("chrom", "pos", "ref", "alt"), path, sep=" ", header=False)
    return spark.read.text(path)


@register("batch_append", """
SELECT pid, vid, beta, 1 AS batch FROM fx_min
UNION ALL SELECT pid, vid, beta, 2 AS batch FROM fx_min""")
def batch_append(spark, sf):
    from polyscore.session import scratch_path
    fx = Fixtures(spark, sf)
    path = scratch_path(spark, "batches")
    part = fx.min_stat.select("pid", "vid", "beta")
    sinks.append_batch(part, path)
    sinks.append_batch(part, path)
    return spark.read.parquet(path).select("pid", "vid", "beta", "batch")


@register("flatten_primitives", """
SELECT pid, vid, pop, beta AS "stats.beta", p AS "stats.p", low_confidence AS "stats.low_confidence"
FROM fx_sumstats""")
def flatten_primitives(spark, sf):
    fx = Fixtures(spark, sf)
    nested = fx.sumstats.select("pid", "vid", "pop", F.struct("beta", "p", "low_confidence").alias("stats"),
                                F.array("beta", "se").alias("arr"))
    return sinks.select_primitives(nested)


@register("resume_missing_parts", """
SELECT DISTINCT pid // 10 AS part_id FROM fx_pheno WHERE (pid // 10) % 2 = 1""")
def resume_missing_parts(spark, sf):
    from polyscore.session import scratch_path
    fx = Fixtures(spark, sf)
    path = scratch_path(spark, "parts")
    wanted = fx.pheno.select("pid", F.expr("pid DIV 10").alias("part_id"))
    sinks.write_parts(wanted.where("part_id % 2 = 0"), path)
    return sinks.missing_parts(wanted, spark, path)


# ---------------------------------------------------------------- projections and filters

@register("project_rename", "SELECT vid, pid, pop, beta AS BETA, p AS Pvalue FROM fx_sumstats")
def project_rename(spark, sf):
    fx = Fixtures(spark, sf)
    return fx.sumstats.select("vid", "pid", "pop", "beta", "p").withColumnsRenamed({"beta": "BETA", "p": "Pvalue"})


@register("filter_membership", f"""
SELECT s.pid, s.vid, s.pop, s.beta FROM fx_sumstats s JOIN fx_pheno ph ON s.pid = ph.pid
WHERE ph.trait_type IN ({", ".join(repr(t) for t in QUANT_TRAIT_TYPES)})
  AND s.pid IN (SELECT pid FROM fx_pheno_pop WHERE pop = 'EUR')""")
def filter_membership(spark, sf):
    fx = Fixtures(spark, sf)
    quant = flt.filter_membership(fx.pheno, "trait_type", QUANT_TRAIT_TYPES).select("pid")
    eur = fx.pheno_pop.where(F.col("pop") == "EUR").select("pid")
    s = fx.sumstats.select("pid", "vid", "pop", "beta").join(quant, "pid", "left_semi")
    return flt.filter_membership(s, "pid", eur)


_FIVE_SETS = [",".join(c) for c in combinations(POPS, 5)]


@register("popset_equals", f"""
SELECT pid, pops_str FROM (SELECT pid, array_to_string(list_sort(list(DISTINCT pop)), ',') AS pops_str
FROM fx_pheno_pop GROUP BY pid) WHERE pops_str IN ({", ".join(repr(s) for s in _FIVE_SETS)})""")
def popset_equals(spark, sf):
    fx = Fixtures(spark, sf)
    g = fx.pheno_pop.groupBy("pid").agg(F.collect_list("pop").alias("pops"))
    cond = None
    for c in combinations(POPS, 5):
        e = set_equals("pops", c)
        cond = e if cond is None else (cond | e)
    return g.where(cond).select("pid", F.array_join(F.array_sort(F.array_distinct("pops")), ",").alias("pops_str"))


@register("filter_npops", """
SELECT pid FROM fx_pheno_pop GROUP BY pid HAVING count(*) = 6""")
def filter_npops(spark, sf):
    fx = Fixtures(spark, sf)
    cols = rs.pheno_data_arrays(fx.pheno_pop)
    return cols.where((F.size("pheno_data") == 6) & (F.size("pheno_data") > 0)).select("pid")


_AF_AN_SQL = """(SELECT vid, pop, max(af) AS af, CAST(2 * sum(n) AS BIGINT) AS an FROM fx_sumstats GROUP BY vid, pop)"""


def _af_an_maps(fx):
    per = fx.sumstats.groupBy("vid", "pop").agg(F.max("af").alias("af"), (F.sum("n") * 2).alias("an"))
    return per.groupBy("vid").agg(F.map_from_entries(F.collect_list(F.struct("pop", "af"))).alias("af_map"),
                                  F.map_from_entries(F.collect_list(F.struct("pop", "an"))).alias("an_map"))


@register("variant_min_count", f"""
SELECT vid, bool_or(pop = 'EUR' AND af * an >= 20) AS pass_eur FROM {_AF_AN_SQL} t
GROUP BY vid HAVING bool_or(af * an >= 20)""")
def variant_min_count(spark, sf):
    fx = Fixtures(spark, sf)
    m = _af_an_maps(fx)
    return m.where(flt.min_allele_count("af_map", "an_map")).select(
        "vid", flt.min_allele_count("af_map", "an_map", pops=["EUR"]).alias("pass_eur"))


@register("hq_variants", "SELECT vid, chrom, pos FROM fx_variant WHERE high_quality")
def hq_variants(spark, sf):
    fx = Fixtures(spark, sf)
    return fx.variant.where(F.col("high_quality")).select("vid", "chrom", "pos")


_CI_COLS = f"{PHENO_ID_SQL} AS pheno_id, {VARID_SQL} AS SNP, v.chrom, v.pos"


@register("clump_input_single", f"""
SELECT {_CI_COLS}, s.p AS P, 'single' AS source
FROM fx_sumstats s JOIN fx_pheno ph ON s.pid = ph.pid JOIN fx_variant v ON s.vid = v.vid
WHERE s.pop = 'EUR' AND s.p IS NOT NULL AND coalesce(NOT s.low_confidence, true) AND coalesce(v.high_quality, true)""")
def clump_input_single(spark, sf):
    from polyscore.plans.clumping import clump_input
    return clump_input(Fixtures(spark, sf), selection="single_pop", pop="EUR")


@register("clump_input_meta", f"""
SELECT {_CI_COLS}, m.p AS P, 'meta' AS source
FROM fx_meta m JOIN fx_num_pops n ON m.pid = n.pid JOIN fx_pheno ph ON m.pid = ph.pid JOIN fx_variant v ON m.vid = v.vid
WHERE n.num_pops > 1 AND m.meta_ix = 0 AND m.p IS NOT NULL AND coalesce(v.high_quality, true)
UNION ALL
SELECT {_CI_COLS}, s.p AS P, 'single' AS source
FROM fx_sumstats s JOIN fx_num_pops n ON s.pid = n.pid JOIN fx_pheno ph ON s.pid = ph.pid JOIN fx_variant v ON s.vid = v.vid
WHERE n.num_pops = 1 AND s.p IS NOT NULL AND coalesce(NOT s.low_confidence, true) AND coalesce(v.high_quality, true)""")
def clump_input_meta(spark, sf):
    from polyscore.plans.clumping import clump_input
    return clump_input(Fixtures(spark, sf), selection="max_pops")


@register("clump_input_loo", f"""
SELECT {_CI_COLS}, m.p AS P, 'loo' AS source
FROM fx_meta m JOIN fx_num_pops n ON m.pid = n.pid JOIN fx_pheno ph ON m.pid = ph.pid JOIN fx_variant v ON m.vid = v.vid
WHERE n.num_pops = 6 AND m.meta_ix = 5 AND m.p IS NOT NULL
UNION ALL
SELECT {_CI_COLS}, m.p AS P, 'meta' AS source
FROM fx_meta m JOIN fx_num_pops n ON m.pid = n.pid JOIN fx_pheno ph ON m.pid = ph.pid JOIN fx_variant v ON m.vid = v.vid
WHERE n.num_pops = 5 AND m.pid NOT IN (SELECT pid FROM fx_pheno_pop WHERE pop = 'EUR')
  AND m.meta_ix = 0 AND m.p IS NOT NULL AND coalesce(v.high_quality, true)""")
def clump_input_loo(spark, sf):
    from polyscore.plans.clumping import clump_input
    return clump_input(Fixtures(spark, sf), selection="not_pop", pop="EUR")


@register("pheno_selection", """
SELECT pid, 'single_pop' AS mode FROM fx_pheno_pop WHERE pop = 'EUR'
UNION ALL SELECT pid, 'not_pop' AS mode FROM fx_num_pops n
  WHERE num_pops = 6 OR (num_pops = 5 AND pid NOT IN (SELECT pid FROM fx_pheno_pop WHERE pop = 'EUR'))
UNION ALL SELECT pid, 'max_pops' AS mode FROM fx_num_pops""")
def pheno_selection(spark, sf):
    fx = Fixtures(spark, sf)
    phenos = fx.pheno_pop.groupBy("pid").agg(F.collect_list("pop").alias("pops"))
    out = None
    for mode in ("single_pop", "not_pop", "max_pops"):
        sel = flt.select_phenos_for_clump(phenos, "EUR", mode).select("pid", F.lit(mode).alias("mode"))
        out = sel if out is None else out.unionByName(sel)
    return out


@register("slice_modulo", f"""
SELECT pid, CAST((row_number() OVER (ORDER BY {PHENO_ID_SQL}) - 1) % 7 AS INTEGER) AS slice FROM fx_pheno""")
def slice_modulo(spark, sf):
    fx = Fixtures(spark, sf)
    return flt.slice_modulo(fx.pheno.select("pid", ids.pheno_id().alias("pheno_id")), ["pheno_id"], 7) \
        .select("pid", "slice")


@register("slice_contiguous", f"""
SELECT pid, CAST((row_number() OVER (ORDER BY {PHENO_ID_SQL}) - 1) // CAST(ceil(count(*) OVER () / 7) AS BIGINT) + 1
  AS INTEGER) AS slice FROM fx_pheno""")
def slice_contiguous(spark, sf):
    fx = Fixtures(spark, sf)
    return flt.slice_contiguous(fx.pheno.select("pid", ids.pheno_id().alias("pheno_id")), ["pheno_id"], 7) \
        .select("pid", "slice")


@register("modifier_fix", """
SELECT pid, trait_type, CASE WHEN trait_type = 'biomarkers' THEN 'irnt' ELSE modifier END AS modifier FROM fx_pheno""")
def modifier_fix(spark, sf):
    fx = Fixtures(spark, sf)
    return fx.pheno.select("pid", "trait_type", ids.normalize_modifier().alias("modifier"))


@register("clump_mode", """
WITH ph AS (SELECT pid, count(*) AS k, array_to_string(list_sort(list(pop)), '-') AS own FROM fx_pheno_pop GROUP BY pid)
SELECT pid, pop, 'single_pop' AS selection, 'single' AS mode, pop AS panel FROM fx_pheno_pop
UNION ALL
SELECT ph.pid, x.pop, 'not_pop' AS selection, CASE WHEN ph.k = 6 THEN 'loo' ELSE 'meta' END AS mode,
  (SELECT array_to_string(list_sort(list(y.pop)), '-') FROM fx_pops y WHERE y.pop <> x.pop) AS panel
FROM ph CROSS JOIN fx_pops x
WHERE ph.k = 6 OR (ph.k = 5 AND NOT EXISTS (SELECT 1 FROM fx_pheno_pop q WHERE q.pid = ph.pid AND q.pop = x.pop))
UNION ALL
SELECT pid, NULL AS pop, 'max_pops' AS selection, CASE WHEN k > 1 THEN 'meta' ELSE 'single' END AS mode, own AS panel
FROM ph""")
def clump_mode(spark, sf):
    from polyscore.plans.clumping import clump_modes
    fx = Fixtures(spark, sf)
    return clump_modes(fx.pheno_pop)


@register("pops_equal", """
SELECT m.pid, m.meta_ix FROM fx_meta_data m JOIN (SELECT pid, array_to_string(list_sort(list(pop)), ',') AS s
  FROM fx_pheno_pop GROUP BY pid) p ON m.pid = p.pid AND m.pops_str = p.s""")
def pops_equal(spark, sf):
    fx = Fixtures(spark, sf)
    own = fx.pheno_pop.groupBy("pid").agg(F.array_sort(F.collect_list("pop")).alias("clump_pops"))
    return fx.meta_data.join(own, "pid").where(F.col("pops") == F.col("clump_pops")).select("pid", "meta_ix")


@register("cases_of_trait", """
SELECT user_id FROM fx_phenotype WHERE pid = 7 AND both_sexes = 1""")
def cases_of_trait(spark, sf):
    fx = Fixtures(spark, sf)
    return fx.phenotype.where((F.col("pid") == 7) & (F.col("both_sexes") == 1)).select("user_id")


# ---------------------------------------------------------------- scalar functions

@register("pheno_id", f"SELECT pid, {PHENO_ID_SQL} AS pheno_id FROM fx_pheno")
def pheno_id(spark, sf):
    fx = Fixtures(spark, sf)
    return fx.pheno.select("pid", ids.pheno_id().alias("pheno_id"))


@register("variant_id", f"SELECT vid, {VARID_SQL} AS varid FROM fx_variant")
def variant_id(spark, sf):
    fx = Fixtures(spark, sf)
    return fx.variant.select("vid", ids.variant_id().alias("varid"))


@register("locus_parts", f"""
SELECT vid, split_part(varid, ':', 1) AS chrom, CAST(split_part(varid, ':', 2) AS INTEGER) AS pos,
  split_part(varid, ':', 3) AS ref, split_part(varid, ':', 4) AS alt, 'chr' || split_part(varid, ':', 1) AS contig,
  split_part(varid, ':', 3) || ',' || split_part(varid, ':', 4) AS alleles
FROM (SELECT vid, {VARID_SQL} AS varid FROM fx_variant)""")
def locus_parts(spark, sf):
    fx = Fixtures(spark, sf)
    v = fx.variant.select("vid", ids.variant_id().alias("varid"))
    return v.select("vid", *ids.split_variant_id("varid"),
                    ids.with_chr_prefix(F.split("varid", ":")[0]).alias("contig"),
                    F.array_join(ids.alleles_of("varid"), ",").alias("alleles"))


@register("format_stat", """
SELECT pid, vid, pop, printf('%.3e', beta) AS beta, printf('%.3e', p) AS pval, printf('%.3e', se) AS se,
  CASE WHEN low_confidence THEN 'true' WHEN NOT low_confidence THEN 'false' END AS low_confidence
FROM fx_sumstats""")
def format_stat(spark, sf):
    fx = Fixtures(spark, sf)
    return fx.sumstats.select("pid", "vid", "pop", fmt.format_stat("beta").alias("beta"),
                              fmt.format_stat("p").alias("pval"), fmt.format_stat("se").alias("se"),
                              fmt.format_bool("low_confidence").alias("low_confidence"))


@register("delimit_pops", """
SELECT pid, pops, CAST(len(string_split(pops, ',')) AS INTEGER) AS n_pops FROM
  (SELECT pid, array_to_string(list_sort(list(pop)), ',') AS pops FROM fx_pheno_pop GROUP BY pid)""")
def delimit_pops(spark, sf):
    fx = Fixtures(spark, sf)
    g = fx.pheno_pop.groupBy("pid").agg(F.array_join(F.array_sort(F.collect_list("pop")), ",").alias("pops"))
    return g.select("pid", "pops", F.size(F.split("pops", ",")).alias("n_pops"))


@register("array_ops", """
SELECT pid,
  CAST(count(*) AS INTEGER) AS n_pops,
  CAST(sum(CASE WHEN lambda_gc > 0.5 AND lambda_gc < 2 THEN 1 ELSE 0 END) AS INTEGER) AS n_ok,
  bool_or(n_cases > 500) AS any_big,
  bool_and(n_controls >= 1000) AS all_controls,
  bool_or(pop = 'EUR') AS has_eur,
  CAST(count(*) FILTER (WHERE pop < 'EUR') AS INTEGER) AS eur_index,
  CAST(sum(n_cases) AS BIGINT) AS total_cases
FROM fx_pheno_pop GROUP BY pid""")
def array_ops(spark, sf):
    fx = Fixtures(spark, sf)
    cols = rs.pheno_data_arrays(fx.pheno_pop)
    pd_ = F.col("pheno_data")
    eur_ix = index_of(pd_["pop"], F.lit("EUR"))
    return cols.select(
        "pid", F.size(pd_).alias("n_pops"),
        F.size(F.filter(pd_, lambda x: flt.lambda_gc_ok(x["lambda_gc"]))).alias("n_ok"),
        F.exists(pd_, lambda x: x["n_cases"] > 500).alias("any_big"),
        F.forall(pd_, lambda x: x["n_controls"] >= 1000).alias("all_controls"),
        F.array_contains(pd_["pop"], "EUR").alias("has_eur"),
        F.coalesce(eur_ix, F.size(F.filter(pd_, lambda x: x["pop"] < "EUR"))).cast("int").alias("eur_index"),
        F.aggregate(F.flatten(F.array(F.transform(pd_, lambda x: x["n_cases"]))), F.lit(0).cast("bigint"),
                    lambda acc, x: acc + x).alias("total_cases"))


@register("cast_ids", """
SELECT s, CAST(s AS INTEGER) AS user_id, CAST(CAST(user_id AS INTEGER) AS VARCHAR) AS s2,
  CAST(s AS DOUBLE) AS s_double FROM fx_sample""")
def cast_ids(spark, sf):
    fx = Fixtures(spark, sf)
    return fx.sample.select("s", F.col("s").try_cast("int").alias("user_id"),
                            F.col("user_id").cast("int").cast("string").alias("s2"),
                            F.col("s").try_cast("double").alias("s_double"))


@register("short_description", """
SELECT p_partkey AS pid, CASE WHEN len(string_split(trim(p_name), ' ')) > 4
  THEN array_to_string(string_split(trim(p_name), ' ')[1:4], ' ') || '...' ELSE trim(p_name) END AS description
FROM part""")
def short_description(spark, sf):
    fx = Fixtures(spark, sf)
    return fx.table("part").select(F.col("p_partkey").alias("pid"),
                                   ids.short_description("p_name").alias("description"))


@register("trait_category", f"""
SELECT pid, trait_type, CASE WHEN trait_type IN ({", ".join(repr(t) for t in QUANT_TRAIT_TYPES)}) THEN 'quant'
  WHEN trait_type IN ({", ".join(repr(t) for t in BINARY_TRAIT_TYPES)}) THEN 'binary' END AS category
FROM fx_pheno""")
def trait_category(spark, sf):
    fx = Fixtures(spark, sf)
    return fx.pheno.select("pid", "trait_type", ids.trait_category().alias("category"))


@register("split_snp", f"""
SELECT split_part(SNP, ':', 1) AS chr, CAST(split_part(SNP, ':', 2) AS INTEGER) AS pos,
  split_part(SNP, ':', 3) AS a1, split_part(SNP, ':', 4) AS a2, SNP, pid
FROM (SELECT m.pid, {VARID_SQL} AS SNP FROM fx_min m JOIN fx_variant v ON m.vid = v.vid)""")
def split_snp(spark, sf):
    fx = Fixtures(spark, sf)
    df = fx.min_stat.join(fx.variant, "vid").select("pid", ids.variant_id().alias("SNP"))
    return rs.split_snp(df, "SNP")


@register("invalid_pops", """
SELECT pid, CAST(count(*) FILTER (WHERE pop NOT IN ('AFR', 'AMR', 'CSA', 'EAS', 'EUR', 'MID')) AS INTEGER) AS n_invalid
FROM fx_pheno_pop GROUP BY pid""")
def invalid_pops(spark, sf):
    fx = Fixtures(spark, sf)
    g = fx.pheno_pop.groupBy("pid").agg(F.collect_list("pop").alias("pops"))
    return g.select("pid", F.size(invalid_values("pops", POPS)).alias("n_invalid"))
