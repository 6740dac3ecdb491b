"""The queries of the text operators, over whole tables and whole texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from polyscore.llm import (alignment, decontaminate, divergence, importance, katz, level_packing, line_dedup, packing,
                           partenum, periodic, records, tag_paths, tokens, toxicity)
from polyscore.llm.common import table


def op1_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.quality(table(spark, sf_dir, "documents"))


def op2_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, index = records.write_records(table(spark, sf_dir, "documents"), tokens.default_path())
    return records.read_records(folder, index)


def op3_tag_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_paths.extract(table(spark, sf_dir, "pages"))


def op4_line_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"))


def op5_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokens.default_path())


def op6_prefix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.katz_scores(table(spark, sf_dir, "documents"), order=3)[0]


def op8_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.quality_weights(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_partenum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.jaccard_components(table(spark, sf_dir, "documents")).drop("cls")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), *alignment.default_paths())


def op12_sum_of_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return level_packing.pack_levels(table(spark, sf_dir, "documents"), level_packing.default_path())


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.periodic_runs(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_divergence, op2_records, op3_tag_paths, op4_line_winnowing, op5_best_two_fit,
                            op6_prefix_decontamination, op7_katz, op8_importance, op9_ftrl, op10_partenum,
                            op11_alignment, op12_sum_of_squares, op13_periodic_runs)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+')"

ORACLES: dict[str, str] = {
    "op6_prefix_decontamination": f"""
with b as (select item_id, {_ITEM_WORDS} as w from benchmark),
win as (select distinct item_id, k, array_to_string(w[s:s + k - 1], ' ') as win
        from (select item_id, w, least(10, len(w)) as k, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as s from b where len(w) > 0)),
d as (select doc_id, {_ITEM_WORDS} as w from documents),
pos as (select doc_id, k, s, array_to_string(w[s:s + k - 1], ' ') as win
       from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as s
             from d, (select distinct k from win) where len(w) >= k)),
hit as (select doc_id, s, k, item_id from pos join win using (k, win)),
hit_words as (select doc_id, count(distinct p) as n from (select doc_id, unnest(range(s, s + k)) as p from hit) group by doc_id),
hit_items as (select doc_id, count(*) as n, string_agg(i, ',' order by i) as ids
              from (select distinct doc_id, cast(item_id as varchar) as i from hit) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(hw.n, 0) as bigint) as n_hit,
       cast(coalesce(hi.n, 0) as bigint) as n_items, sha256(coalesce(hi.ids, '')) as items_sha256,
       coalesce(hw.n, 0) > 0 as contaminated
from d left join hit_words hw using (doc_id) left join hit_items hi using (doc_id)""",
    "op10_partenum": f"""
with recursive d as (select doc_id, {_WORDS} as w from documents),
s as (select distinct doc_id, sh from (
        select doc_id, case when len(w) < 5 then array_to_string(w, ' ') else array_to_string(w[i:i + 4], ' ') end as sh
        from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from d where len(w) > 0))),
n as (select doc_id, count(*) as n from s group by doc_id),
link as (select a, b from (select x.doc_id as a, y.doc_id as b, count(*) as c from s x join s y on x.sh = y.sh and x.doc_id <> y.doc_id
                           group by 1, 2) join n na on na.doc_id = a join n nb on nb.doc_id = b
         where 100 * c >= 80 * (na.n + nb.n - c)),
reach(a, b) as (select a, b from link union select r.a, l.b from reach r join link l on r.b = l.a)
select d.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles,
       least(d.doc_id, coalesce(r.least, d.doc_id)) as component_id
from d left join n using (doc_id) left join (select a as doc_id, min(b) as least from reach group by a) r using (doc_id)""",
}
