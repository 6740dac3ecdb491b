"""Alignment of two tokenizers' tokens, and how often their ids are linked.

Both tokenizers cut the same bytes (a blank and the text). The tokens of a part
of a batch are flat Arrow lists with the index of their text; summing the
tokens' byte lengths, anew for each text, gives their ends. A hash join on
(text, end) keeps the ends that both share, which cut the text into groups. A
hash join on the group links its tokens, after equal ids of a group are counted,
so a long group costs the product of its distinct ids only. The links are
grouped by (text, id pair), and a block of texts counts in how many texts it
holds each pair.

Spark adds these partial counts up over all blocks, with partial aggregates
before its shuffle, so a frequent pair costs one row per block. The highest
count of each first id (bounded by the vocabulary) is broadcast. The counts
are joined to the blocks' pairs, which Spark splits where a pair is frequent, and
each block's texts, staged as places in the block's pairs, meet their counts.

Texts that are null, empty, or whose joined tokens of either kind differ from
the blank and the text have no tokens: zeros and an empty ``groups_sha256``.
Repeated rows, null ids among them, are texts of their own in all counts. Ties
for an id's highest count all count as best. A very long text is worked off
alone in its part of a batch. An empty table gives an empty result. Columns
other than doc_id and text are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyscore.llm.common import buffers, map_arrow, slices, stage, texts_of
from polyscore.llm.forms import LibraryEncoder, PieceEncoder, byte_level_bytes, forms_of, remembered

#: Text bytes of a block and of a part of it that is aligned at a time; word forms that a worker remembers.
BLOCK, PART, REMEMBERED = 32 << 20, 2 << 20, 400_000
_DOC = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
_STAGED = ("block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "places binary, links binary, place int, pair long, n long")
_ANSWERED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_TABLES: dict = {}


class Tokens:
    """One tokenizer's tokens of a part's texts, flat: id, index of the text, bytes, end within the text."""

    def __init__(self, ids: np.ndarray, parent: np.ndarray, texts: int, token_bytes: pa.Array):
        lists = pa.ListArray.from_arrays(np.searchsorted(parent, np.arange(texts + 1)).astype(np.int32), pa.array(ids))
        self.ids, self.parent = lists.flatten(), pc.list_parent_indices(lists)
        self.raw = token_bytes.take(self.ids)
        size = pc.binary_length(self.raw).to_numpy().astype(np.int64)
        running = np.concatenate(([0], np.cumsum(size)))
        offsets = lists.offsets.to_numpy()
        self.bytes = running[offsets[1:]] - running[offsets[:-1]]
        self.counts = np.diff(offsets)
        self.end = pa.array(running[1:] - np.repeat(running[offsets[:-1]], self.counts))
        self.offsets = offsets

    def spans(self) -> tuple[np.ndarray, np.ndarray]:
        """All tokens' bytes, one after the other, and where each text's begin."""
        data, off = buffers(self.raw)
        return data, off[self.offsets]

    def only(self, keep: np.ndarray, token_bytes: pa.Array) -> Tokens:
        """The same without the tokens of the texts that aren't kept."""
        stay = keep[self.parent.to_numpy()]
        return Tokens(self.ids.to_numpy()[stay], self.parent.to_numpy()[stay], len(keep), token_bytes)


def whole(x: Tokens, data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Whether a text's tokens give its bytes."""
    good = x.bytes == np.diff(off)
    got, begin = x.spans()
    if good.all() and np.array_equal(got, data):
        return good
    for i in np.flatnonzero(good).tolist():
        good[i] = np.array_equal(got[begin[i]:begin[i + 1]], data[off[i]:off[i + 1]])
    return good


def group_of(x: Tokens, last: np.ndarray) -> np.ndarray:
    """The group of every token; ``last`` are the tokens that end the groups, in order."""
    return np.searchsorted(last, np.arange(len(x.ids)), "left")


def shared_ends(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of each kind that end where one of the other kind ends too, in order."""
    side = lambda x, name: pa.table({"text": x.parent, "end": x.end, name: pa.array(np.arange(len(x.ids)))})
    both = side(a, "a").join(side(b, "b"), ["text", "end"], join_type="inner", use_threads=False)
    return np.sort(both["a"].to_numpy()), np.sort(both["b"].to_numpy())


def linked(a: Tokens, b: Tokens, group_a: np.ndarray, group_b: np.ndarray) -> pa.Table:
    """text, pair (first id << 32 | second id) and the number of links."""
    def counted(x: Tokens, group: np.ndarray, name: str, repeated: np.ndarray) -> pa.Table:
        t = pa.table({"group": group, name: pc.cast(x.ids, pa.int64()), f"n_{name}": np.ones(len(group), np.int64)})
        many = repeated[group]
        if not many.any():
            return t
        own = t.filter(pa.array(many)).group_by(["group", name], use_threads=False).aggregate([(f"n_{name}", "sum")])
        return pa.concat_tables([t.filter(pa.array(~many)),
                                 own.rename_columns([c.removesuffix("_sum") for c in own.column_names]).select(t.column_names)])

    n = int(group_a[-1]) + 1 if len(group_a) else 0
    long = (np.bincount(group_a, minlength=n) > 8) | (np.bincount(group_b, minlength=n) > 8)
    text = np.zeros(n, np.int64)
    text[group_a] = a.parent.to_numpy()
    t = counted(a, group_a, "a", long).join(counted(b, group_b, "b", long), "group", join_type="inner", use_threads=False)
    pair = (t["a"].to_numpy() << 32) | t["b"].to_numpy()
    out = pa.table({"text": text[t["group"].to_numpy()], "pair": pair, "links": t["n_a"].to_numpy() * t["n_b"].to_numpy()})
    return out.group_by(["text", "pair"], use_threads=False).aggregate([("links", "sum")])


def digests(a: Tokens, b: Tokens, last_a: np.ndarray, last_b: np.ndarray, names: pa.Array) -> list[str]:
    """sha256 of each text's groups, written ``a1,a2|b1;a3|b2``; empty without tokens."""
    def written(x: Tokens, last: np.ndarray) -> pa.Array:
        lists = pa.ListArray.from_arrays(np.concatenate(([0], last + 1)).astype(np.int32), names.take(x.ids))
        return pc.binary_join(lists, ",")

    groups = pc.binary_join_element_wise(written(a, last_a), written(b, last_b), "|")
    per_text = np.searchsorted(last_a, a.offsets, "left").astype(np.int32)
    joined = pc.binary_join(pa.ListArray.from_arrays(per_text, groups), ";")
    return [hashlib.sha256(s.as_buffer()).hexdigest() if n else "" for s, n in zip(joined, a.counts.tolist())]


def _tables(path_a: str, path_b: str) -> tuple:
    """The worker's encoders, both kinds' token bytes and the decimal names of ids."""
    if (path_a, path_b) not in _TABLES:
        one, two = remembered(LibraryEncoder, path_a), remembered(PieceEncoder, path_b)
        one.memory.most = two.memory.most = REMEMBERED
        raw = byte_level_bytes(one.tokenizer), two.token_bytes()
        names = pa.array([str(i) for i in range(max(map(len, raw)))])
        _TABLES[path_a, path_b] = (one, two, *(pa.array(r, pa.binary()) for r in raw), names)
    return _TABLES[path_a, path_b]


def align_part(column: pa.Array, path_a: str, path_b: str) -> tuple[list, pa.Table]:
    """Per text n_a, n_b, n_groups, n_links and the digest; and the table of ``linked``."""
    one, two, bytes_a, bytes_b, names = _tables(path_a, path_b)
    texts = len(column)
    filled = pc.greater(pc.binary_length(column), 0)
    column = pc.if_else(filled, pc.binary_join_element_wise(pa.scalar(b" "), column, b""), b"")
    data, off = buffers(column)
    forms, row = forms_of(data, off)
    distinct = forms.dictionary.to_pylist()
    kinds = []
    for encoder, token_bytes in ((one, bytes_a), (two, bytes_b)):
        ids, count = encoder.memory.ids(forms, distinct) if len(row) else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        kinds.append(Tokens(ids, np.repeat(row, count), texts, token_bytes))
    a, b = kinds
    good = whole(a, data, off) & whole(b, data, off)
    if not good.all():
        a, b = a.only(good, bytes_a), b.only(good, bytes_b)
    last_a, last_b = shared_ends(a, b)
    group_a, group_b = group_of(a, last_a), group_of(b, last_b)
    links = linked(a, b, group_a, group_b)
    n_groups = np.diff(np.searchsorted(last_a, a.offsets, "left"))
    n_links = np.bincount(links["text"].to_numpy(), weights=links["links_sum"].to_numpy(), minlength=texts).astype(np.int64)
    return [a.counts.astype(np.int64), b.counts.astype(np.int64), n_groups.astype(np.int64), n_links,
            digests(a, b, last_a, last_b, names)], links


def _packed(n: np.ndarray) -> np.ndarray:
    """Small counts as bytes; 255 stands for a larger one, which follows at the end."""
    return np.minimum(n, 255).astype(np.uint8)


def _batch(schema: str, columns: dict, n: int) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[name], kinds[kind]) if name in columns else pa.nulls(n, kinds[kind]) for name, kind in fields],
        [name for name, _ in fields])


def aligned_blocks(docs: DataFrame, path_a: str, path_b: str, block_bytes: int = BLOCK) -> DataFrame:
    """Rows of texts (places in the block's pairs, links of each) and rows of a block's pairs (n: texts that hold it)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        size = 0

        def finish() -> Iterator[pa.RecordBatch]:
            pairs, place = np.unique(np.concatenate([x[2] for x in held]), return_inverse=True)
            n = np.bincount(place, minlength=len(pairs))
            for at in range(0, len(pairs), 1 << 16):
                some = slice(at, min(at + (1 << 16), len(pairs)))
                k = some.stop - at
                yield _batch(_STAGED, {"block": np.full(k, block), "place": np.arange(at, some.stop, dtype=np.int32),
                                       "pair": pairs[some], "n": n[some]}, k)
            done = 0
            for doc_ids, columns, mine, cuts, links in held:
                places = place[done:done + len(mine)].astype("<u4")
                done += len(mine)
                raw, small = places.tobytes(), _packed(links)
                large = links.astype("<i8")
                spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
                yield _batch(_STAGED, dict(zip(_DOC, [doc_ids, *columns])) | {
                    "block": np.full(len(doc_ids), block),
                    "places": [raw[4 * i:4 * j] for i, j in spans],
                    "links": [small[i:j].tobytes() + large[i:j][small[i:j] == 255].tobytes() for i, j in spans]}, len(doc_ids))

        for batch in batches:
            for part in slices(batch, PART):
                columns, links = align_part(part.column(1), path_a, path_b)
                text, pair, n = (links[c].to_numpy() for c in ("text", "pair", "links_sum"))
                order = np.lexsort((pair, text))
                held.append((part.column(0), columns, pair[order],
                             np.searchsorted(text[order], np.arange(part.num_rows + 1)), n[order]))
                size += part.column(1).nbytes
                if size >= block_bytes:
                    yield from finish()
                    held, size, block = [], 0, block + 1
        if held:
            yield from finish()

    rows = texts_of(docs, "doc_id").withColumn("doc_id", F.col("doc_id").cast("long"))
    return map_arrow(rows, run, _STAGED)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """pair, count (texts of the corpus that hold it linked) and best (the highest count of its first id, ties included)."""
    counts = stage(blocks.where("pair is not null").groupBy("pair").agg(F.sum("n").alias("count")), "pair-counts")
    first = F.shiftright("pair", 32)
    highest = counts.groupBy(first.alias("first")).agg(F.max("count").alias("highest"))
    # one row per id of the first vocabulary at most
    return (counts.join(F.broadcast(highest), first == F.col("first"))
            .select("pair", "count", (F.col("count") == F.col("highest")).alias("best")))


def align(docs: DataFrame, path_a: str, path_b: str, block_bytes: int = BLOCK) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of ``docs`` (doc_id, text)."""
    blocks = stage(aligned_blocks(docs, path_a, path_b, block_bytes), "aligned")
    answers = (blocks.where("pair is not null").select("block", "place", "pair").join(pair_counts(blocks), "pair")
               .select("block", "place", "count", "best"))
    texts = blocks.where("pair is null").drop("place", "pair", "n")
    rows = answers.unionByName(texts, allowMissingColumns=True).repartition("block").sortWithinPartitions(
        F.col("block"), F.col("place").asc_nulls_last())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, count, best = None, [], None, None
        for batch in batches:
            block = batch.column("block").to_numpy()
            for a, b in _runs(block):
                if block[a] != now:
                    now, parts, count = block[a], [], None
                part = batch.slice(a, b - a)
                answered = part.num_rows - part.column("place").null_count
                if answered:
                    parts.append((part.column("count").slice(0, answered).to_numpy(),
                                  part.column("best").slice(0, answered).to_numpy(zero_copy_only=False)))
                part = part.slice(answered)
                if not part.num_rows:
                    continue
                if count is None:
                    count = np.concatenate([p for p, _ in parts] or [np.zeros(0, np.int64)])
                    best = np.concatenate([p for _, p in parts] or [np.zeros(0, bool)]).astype(np.int64)
                n_best, total = np.zeros(part.num_rows, np.int64), np.zeros(part.num_rows, np.int64)
                for i, (places, links) in enumerate(zip(part.column("places"), part.column("links"))):
                    at = np.frombuffer(places.as_buffer(), "<u4")
                    n = np.frombuffer(links.as_buffer(), np.uint8, len(at)).astype(np.int64)
                    if (n == 255).any():
                        n[n == 255] = np.frombuffer(links.as_buffer(), "<i8", offset=len(at))
                    n_best[i], total[i] = n @ best[at], n @ count[at]
                yield _batch(_ANSWERED, {c: part.column(c) for c in _DOC} | {"n_best": n_best, "count_sum": total}, part.num_rows)

    return map_arrow(rows, score, _ANSWERED)


def _runs(block: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
    return ((a, b) for a, b in zip(cuts[:-1], cuts[1:]) if b > a)


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
