"""N-gram Jaccard join by PartEnum signatures, and its connected components.

Sets of word shingles with Jaccard similarity of at least ``PERCENT`` / 100
differ in at most k = (|x| + |y|) (100 - PERCENT) / (100 + PERCENT) elements.
The shingle domain is partitioned by hash into groups of three parts. In a group
where two sets differ in one part at most, one of the three subsets of two parts
is equal in both, so each subset's content is a signature. Two linked sets
differ in two or more parts in k / 2 groups at most. A set therefore needs
signatures of its first k / 2 + 1 groups only, counted so that groups where it
has a single non-empty part (which one difference can empty) count extra; the
order of the groups is fixed, with the shingles that a bounded sample shows to
be frequent in groups of their own at the end, so passages that many documents
share rarely make signatures. The sample changes the work, never the result.

Sets of like size share a band (a power of two) and its number of groups; a set
whose partners may be in the next band signs for both. Sets with too few
non-empty groups (a handful of shingles) sign by their first k + 1 shingles too.

Equal sets are one class. Classes that share a signature are held against the
most central class of the group first, the one with most shared signatures, which
joins true groups of copies with one comparison per member. Where a signature's
classes are still in different components after that, those outside the group's
largest component are queries: they are held against that component and
against each other in tiles of bounded size, a block of queries against a block of
classes, so no pair of a group becomes a row. Every link is verified on the
whole texts.

A document with fewer words than a shingle is one shingle of all its words. A
null or empty text has no set and links with nothing; its component is its own
id. Rows of the same set are one class, whatever their ids; a class whose ids are
all null has a null component. Ties and repeated rows need no order. Columns
other than doc_id and text are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from polyscore.llm.common import buffers, map_arrow, mix, ngrams, row_of, rows_per_task, slices, space_lut, stage, texts_of, words
from polyscore.llm.components import components

SHINGLE = 5
PERCENT = 80
PARTS = 3
#: Documents of the sample that shows frequent shingles, and in how many of them a shingle is one.
SAMPLE, FREQUENT = 8192, 3
#: Queries and classes of a tile.
QUERIES, HELD = 256, 2048
#: Shingles of the sets that a task keeps while it verifies pairs.
RECENT = 1 << 21
_LUT = space_lut(True)
#: The part of a shingle by the low byte of its hash, and the parts that stay when one is left out.
_PART = np.arange(256) % PARTS
_OTHERS = np.array([[q for q in range(PARTS) if q != p] for p in range(PARTS)])


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    data, off = buffers(column)
    h, s, _ = words(data, off, _LUT)
    row = row_of(s, off)
    n = len(column)
    g, at = ngrams(h, size, row)
    cut = np.searchsorted(row[at], np.arange(n + 1))
    begin = np.searchsorted(row, np.arange(n + 1))
    out = []
    for i in range(n):
        part = g[cut[i]:cut[i + 1]]
        if len(part):
            out.append(np.unique(part))
        else:  # fewer words than a shingle
            k = int(begin[i + 1] - begin[i])
            out.append(ngrams(h[begin[i]:begin[i + 1]], k, np.zeros(k, np.int64))[0] if k else part)
    return out


def set_class(s: np.ndarray) -> int:
    """A 64-bit name of a set."""
    with np.errstate(over="ignore"):
        both = mix(s).sum(dtype=np.uint64) + mix(np.bitwise_xor.reduce(s) + np.uint64(len(s)))
    return int(mix(both[None] if both.ndim else np.array([both]))[0].view(np.int64))


def most_differences(n: int, percent: int = PERCENT) -> int:
    """The most elements by which a set of n and any set linked to it differ."""
    return (n + n * 100 // percent) * (100 - percent) // (100 + percent)


def _groups(band: int, percent: int) -> int:
    return -(-most_differences(2 << band, percent) * 6 // 10) + 3


def signatures(s: np.ndarray, frequent: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The signatures of a set of at least one element."""
    n = len(s)
    k = most_differences(n, percent)
    band = n.bit_length() - 1
    common = _contains(frequent, s)
    out, sparse = [], False
    for b in (band, band + 1):
        if b > band and n * 100 // percent < 1 << b:
            break
        groups = _groups(b, percent)
        with np.errstate(over="ignore"):
            m = mix(s * np.uint64(0x9E3779B97F4A7C15) + np.uint64(b))
        group = ((m >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64) + groups * common
        slot = group * PARTS + _PART[m.view(np.int64) & 255]
        order = np.argsort(slot, kind="stable")
        slot = slot[order]
        first = np.flatnonzero(np.concatenate(([True], slot[1:] != slot[:-1])))
        table = np.zeros(2 * groups * PARTS, np.uint64)
        full = np.zeros(len(table), bool)
        with np.errstate(over="ignore"):
            table[slot[first]] = np.add.reduceat(mix(m[order]), first)
        full[slot[first]] = True
        full = full.reshape(-1, PARTS)
        filled = full.sum(1)
        group = np.flatnonzero(filled)
        lone = np.cumsum(filled[group] == 1)
        enough = np.arange(1, len(group) + 1) > (k + np.minimum(lone, k)) // 2
        need = int(np.argmax(enough)) + 1 if enough.any() else len(group)
        sparse |= not enough.any()
        group = group[:need]
        full, table = full[group], table.reshape(-1, PARTS)[group]
        one, two = _OTHERS[:, 0], _OTHERS[:, 1]
        with np.errstate(over="ignore"):
            tag = mix((np.arange(b * PARTS, b * PARTS + PARTS) + (group << 8)[:, None]).astype(np.uint64))
            total = table[:, one] + table[:, two] * np.uint64(0xD6E8FEB86659FD93)
        out.append(mix((total ^ tag)[full[:, one] | full[:, two]]))
    if sparse:
        out.append(mix(s[:k + 1] ^ np.uint64(0xA0761D6478BD642F)))
    return np.concatenate(out).view(np.int64)


def _contains(sorted_keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.zeros(len(values), np.int64)
    at = np.searchsorted(sorted_keys, values)
    at[at == len(sorted_keys)] = 0
    return (sorted_keys[at] == values).astype(np.int64)


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    same = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * same >= percent * (len(a) + len(b) - same) and same > 0


def _sets(docs: DataFrame) -> DataFrame:
    """doc_id, a hash of the text, n_shingles and class (null without a set) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets = shingle_sets(part.column(2))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([set_class(s) if len(s) else None for s in sets], pa.int64())],
                    ["doc_id", "text_hash", "n_shingles", "cls"])

    rows = texts_of(docs, "doc_id").select(F.col("doc_id").cast("long").alias("doc_id"),
                                           F.xxhash64("text").alias("text_hash"), "text")
    return map_arrow(rows, run, "doc_id long, text_hash long, n_shingles long, cls long")


def _frequent(docs: DataFrame, sets: DataFrame, sample: int, least: int) -> np.ndarray:
    """Shingles in ``least`` or more classes of a sample of at most ``sample`` classes."""
    chosen = (sets.where("cls is not null and doc_id is not null").groupBy("cls").agg(F.min("doc_id").alias("doc_id"))
              .orderBy(F.xxhash64("cls"), "cls").limit(sample).select("doc_id").distinct())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                keys, n = np.unique(np.concatenate(shingle_sets(part.column(0))), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], ["key", "n"])

    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")  # ``sample`` ids
            .select(F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")))
    found = map_arrow(rows, run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return np.sort(np.array([r["key"] for r in found.select("key").collect()], np.int64).view(np.uint64))  # a sample's shingles


def _signature_rows(docs: DataFrame, frequent: np.ndarray, percent: int) -> DataFrame:
    """sig, cls, n of every class; a class that a task meets again isn't signed again."""
    held = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            for part in slices(batch):
                sig, cls, n = [], [], []
                for s in shingle_sets(part.column(0)):
                    if not len(s):
                        continue
                    c = set_class(s)
                    if c in met:
                        continue
                    met.add(c)
                    got = signatures(s, held.value, percent)
                    sig.append(got)
                    cls.append(np.full(len(got), c))
                    n.append(np.full(len(got), len(s), np.int32))
                if sig:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(x)) for x in (sig, cls, n)], ["sig", "cls", "n"])

    return map_arrow(texts_of(docs), run, "sig long, cls long, n int")


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose texts are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: dict[int, np.ndarray] = {}
        held = 0
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                ids = [part.column(i).to_pylist() for i in (0, 1)]
                if held > RECENT:
                    recent, held = {}, 0
                for side in (0, 1):
                    new = {c: i for i, c in enumerate(ids[side]) if c not in recent}
                    if new:
                        for c, s in zip(new, shingle_sets(part.column(2 + side).take(pa.array(list(new.values()))))):
                            recent[c] = s
                            held += len(s)
                keep = [linked(recent[a], recent[b], percent) for a, b in zip(*ids)]
                yield part.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    a = texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.select("a", "b").join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b")
    return map_arrow(rows, run, "a long, b long")


def _class_texts(docs: DataFrame, sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """cls and text of the wanted classes, from one row of each."""
    least = (sets.join(wanted, "cls", "left_semi").groupBy("cls")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"))).alias("r"))
             .select("cls", F.col("r.doc_id").alias("doc_id")))
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
            .join(least.withColumnRenamed("doc_id", "least_id"), F.expr("doc_id <=> least_id")).select("cls", "text"))

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # other rows may carry the same id
            for part in slices(batch):
                named = part.column(0).to_pylist()
                yield part.filter(pa.array([len(s) > 0 and set_class(s) == c
                                            for c, s in zip(named, shingle_sets(part.column(1)))], pa.bool_()))

    return map_arrow(rows, own, "cls long, text binary").dropDuplicates(["cls"])


def _tiles(shared: DataFrame, roots: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links between classes of a signature that are in different components."""
    classes = (shared.select("cls").distinct().join(roots.withColumnRenamed("node", "cls"), "cls", "left")
               .select("cls", F.coalesce("root", "cls").alias("root")))
    classes = stage(classes, "rooted")
    lead = Window.partitionBy("sig")
    open_groups = (shared.select("sig", "cls").join(classes, "cls")
                   .withColumn("r0", F.min("root").over(lead)).withColumn("r1", F.max("root").over(lead))
                   .where("r0 <> r1").select("sig", "cls", "root"))
    open_groups = stage(open_groups, "open")
    by_root = open_groups.groupBy("sig", "root").agg(F.count(F.lit(1)).alias("c"))
    largest = by_root.groupBy("sig").agg(F.max(F.struct("c", "root")).alias("top")).select("sig", F.col("top.root").alias("main"))
    queries = stage(open_groups.join(largest, "sig").where("root <> main").select("main", F.col("cls").alias("cls")).distinct(),
                    "queries")
    # a component may hold a third of all classes: its rows meet what is said of it slot by slot
    slot = F.pmod(F.xxhash64("cls", F.lit("slot")), F.lit(rows_per_task(shared))).alias("slot")
    queries = queries.select("main", "cls", slot)
    members = classes.select(F.col("root").alias("main"), "cls", slot)
    wanted = members.select("main", "slot").distinct().join(queries.select("main").distinct(), "main", "left_semi")
    held = stage(queries.unionByName(members.join(wanted, ["main", "slot"], "left_semi")), "held")
    sizes = (queries.groupBy("main").agg(F.count(F.lit(1)).alias("q"))
             .join(held.groupBy("main").agg(F.count(F.lit(1)).alias("h")), "main")
             .select("main", F.ceil(F.col("q") / QUERIES).cast("int").alias("qs"), F.ceil(F.col("h") / HELD).cast("int").alias("hs")))
    sizes = held.select("main", "slot").distinct().join(sizes, "main")
    part = lambda n: F.pmod(F.xxhash64("cls"), F.col(n)).cast("int")
    asked = (queries.join(sizes, ["main", "slot"])
             .select("main", "cls", F.lit(0).alias("side"), part("qs").alias("qb"),
                     F.explode(F.sequence(F.lit(0), F.col("hs") - 1)).alias("hb")))
    given = (held.join(sizes, ["main", "slot"])
             .select("main", "cls", F.lit(1).alias("side"),
                     F.explode(F.sequence(F.lit(0), F.col("qs") - 1)).alias("qb"), part("hs").alias("hb")))
    rows = (asked.unionByName(given).join(texts, "cls").select("main", "qb", "hb", "side", "cls", "text")
            .repartition(rows_per_task(shared), "main", "qb", "hb").sortWithinPartitions("main", "qb", "hb", "side"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, ids, sets, index = None, [], [], None
        for batch in batches:
            for piece in slices(batch):
                a, b = [], []
                keys = list(zip(*(piece.column(c).to_pylist() for c in (0, 1, 2))))
                sides, names = piece.column(3).to_pylist(), piece.column(4).to_pylist()
                for key, side, c, s in zip(keys, sides, names, shingle_sets(piece.column(5))):
                    if key != tile:
                        tile, ids, sets, index = key, [], [], None
                    if side == 0:
                        ids.append(c)
                        sets.append(s)
                        continue
                    if index is None:
                        size = np.array([len(x) for x in sets])
                        index = _Index(np.array(ids, np.int64), size, np.concatenate(sets), np.repeat(np.arange(len(sets)), size))
                    for d in index.linked(s, percent):
                        if d != c:
                            a.append(min(c, d))
                            b.append(max(c, d))
                if a:
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return map_arrow(rows, run, "a long, b long").distinct()


class _Index:
    """The sets of a block of queries, by element."""

    def __init__(self, ids: np.ndarray, size: np.ndarray, elements: np.ndarray, owner: np.ndarray):
        order = np.argsort(elements, kind="stable")
        self.ids, self.size, self.elements, self.owner = ids, size, elements[order], owner[order]

    def linked(self, s: np.ndarray, percent: int) -> list[int]:
        lo = np.searchsorted(self.elements, s, "left")
        many = np.searchsorted(self.elements, s, "right") - lo
        at = np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        same = np.bincount(self.owner[at], minlength=len(self.ids))
        hit = (same > 0) & (100 * same >= percent * (self.size + len(s) - same))
        return self.ids[hit].tolist()


def jaccard_components(docs: DataFrame, percent: int = PERCENT, sample: int = SAMPLE,
                       frequent: int = FREQUENT, text_hash: bool = False) -> DataFrame:
    """Per row: doc_id, n_shingles, cls and component_id (and a hash of the text)."""
    sets = stage(_sets(docs), "sets")
    common = _frequent(docs, sets, sample, frequent)
    group = Window.partitionBy("sig")
    shared = stage(_signature_rows(docs, common, percent)
                   .withColumn("least", F.min("cls").over(group)).withColumn("most", F.max("cls").over(group))
                   .where("least <> most").select("sig", "cls", "n"), "signatures")
    weight = shared.groupBy("cls").agg(F.count(F.lit(1)).alias("weight"))
    star = (shared.join(weight, "cls").withColumn("top", F.max(F.struct("weight", "cls", "n")).over(group))
            .where("cls <> top.cls").where(f"100 * least(n, top.n) >= {percent} * greatest(n, top.n)")
            .select(F.col("top.cls").alias("a"), F.col("cls").alias("b")).distinct())
    star = stage(star, "pairs")
    texts = stage(_class_texts(docs, sets, shared.select("cls").distinct()), "class-texts")
    links = stage(_verified(star, texts, percent), "linked")
    more = stage(_tiles(shared, components(links), texts, percent), "linked")
    roots = components(links.unionByName(more), "links")
    least = sets.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("least_id"))
    by_class = (least.join(roots.withColumnRenamed("node", "cls"), "cls", "left")
                .select("cls", F.coalesce("root", "cls").alias("root"), "least_id"))
    best = by_class.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = stage(by_class.join(best, "root").select("cls", "component_id"), "classes")
    return (sets.join(classes, "cls", "left")
            .select("doc_id", *["text_hash"][:text_hash], "n_shingles", "cls", F.when(F.col("cls").isNull(), F.col("doc_id"))
                    .otherwise(F.col("component_id")).alias("component_id")))


def one_of_each(docs: DataFrame, percent: int = PERCENT, **options) -> DataFrame:
    """The rows of ``docs``, one of each component: the smallest id's; of rows equal in id and text, one.

    Rows without a set or without an id stay.
    """
    names = docs.columns
    found = jaccard_components(docs, percent, text_hash=True, **options)
    drop = (found.where("cls is not null and doc_id <> component_id")
            .select(F.col("doc_id").alias("dropped_id"), F.col("text_hash").alias("dropped_hash")).distinct())
    row_hash = F.xxhash64(F.coalesce(F.col("`text`"), F.lit("")).cast("binary"))
    keep = docs.join(drop, (F.col("`doc_id`").cast("long") == F.col("dropped_id")) & (row_hash == F.col("dropped_hash")),
                     "left_anti")
    again = (found.where("cls is not null and doc_id is not null").groupBy("doc_id", "text_hash").count().where("count > 1")
             .select(F.col("doc_id").alias("dropped_id"), F.col("text_hash").alias("dropped_hash")))
    again = stage(again, "repeated")
    if again.isEmpty():
        return keep
    same = (F.col("`doc_id`").cast("long") == F.col("dropped_id")) & (row_hash == F.col("dropped_hash"))
    rows = keep.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return keep.join(again, same, "left_anti").unionByName(rows).select(*[F.col(f"`{c}`") for c in names])
