"""Benchmark decontamination by a prefix-filtered set join over item-sized windows.

A window of an item (ten words in a row; a shorter item is one window) is the
set of its word shingles. A text holds the window only if it holds all of them,
so under the prefix filter a single shingle is the necessary prefix, and the
rarest in the corpus is taken: the shingles of the windows are counted over all
texts and ordered by that count. Texts are joined on these prefix shingles; the
positional bound (the window must start and end within the text where the
shingle's place in it says) and the length bound prune the candidates; the rest
is verified word by word.

Windows are taken in blocks of a fixed number, and each block is held against
all texts, so the memory of a task is bounded whatever the benchmark's size;
every row of the benchmark takes part. The blocks pass over the rows without a
shuffle.

Null texts and items have no words and hit nothing. Items without an id still
mark words but add no id; items of the same id count once. Repeated rows get
equal results. An empty benchmark leaves all clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyscore.llm.common import alnum_lut, buffers, map_arrow, ngrams, row_of, slices, stage, words

WINDOW = 10
SHINGLE = 3
#: Windows that are held against the texts at once; a bound on memory, not on the benchmark.
BLOCK = 100_000
_LUT = alnum_lut()


class Windows:
    """Windows of some items: word hashes, lengths, item ids."""

    def __init__(self, items: list[tuple], window: int):
        self.ids: list[str | None] = []
        self.words: list[np.ndarray] = []
        seen: dict[tuple, int] = {}
        for item_id, hashes in items:
            h = np.frombuffer(hashes, np.uint64)
            if not len(h):
                continue
            at = range(max(1, len(h) - window + 1))
            for i in at:
                key = (item_id, h[i:i + window].tobytes())
                if key not in seen:
                    seen[key] = 1
                    self.ids.append(item_id)
                    self.words.append(h[i:i + window])
        self.length = np.array([len(w) for w in self.words], np.int64)

    def shingles(self) -> dict[int, list[np.ndarray]]:
        """For each shingle length in use, the shingles of each window (in order)."""
        out: dict[int, dict[int, np.ndarray]] = {}
        for i, w in enumerate(self.words):
            n = min(SHINGLE, len(w))
            out.setdefault(n, {})[i] = ngrams(w, n, np.zeros(len(w), np.int64))[0]
        return out


def _items(benchmark: DataFrame, n_blocks: int, block: int) -> list[tuple]:
    rows = benchmark
    if n_blocks > 1:
        rows = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block)
    return [(None if r["item_id"] is None else str(r["item_id"]), bytes(r["hashes"])) for r in rows.collect()]


def _hash_items(benchmark: DataFrame) -> DataFrame:
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = buffers(batch.column(1))
            h, s, _ = words(data, off, _LUT)
            cut = np.searchsorted(row_of(s, off), np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([h[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
                 pa.array(np.maximum(0, np.diff(cut) - WINDOW + 1) + (np.diff(cut) > 0))],
                ["item_id", "text", "hashes", "n_windows"])

    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"),
                            F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    return map_arrow(rows, hashed, "item_id string, text binary, hashes binary, n_windows long")


def _count(docs: DataFrame, wanted: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """How often each wanted shingle occurs in all texts."""
    known = docs.sparkSession.sparkContext.broadcast(wanted)  # at most BLOCK windows' shingles

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {n: np.zeros(len(k), np.int64) for n, k in known.value.items()}
        for batch in batches:
            for part in slices(batch):
                data, off = buffers(part.column(0))
                h, s, _ = words(data, off, _LUT)
                row = row_of(s, off)
                for n, k in known.value.items():
                    place, found = _find(k, ngrams(h, n, row)[0])
                    sums[n] += np.bincount(place[found], minlength=len(k))
        for n, c in sums.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), n, np.int32)), pa.array(at), pa.array(c[at])], ["n", "at", "c"])

    got = map_arrow(docs.select("text"), count, "n int, at long, c long").groupBy("n", "at").agg(F.sum("c").alias("c"))
    out = {n: np.zeros(len(k), np.int64) for n, k in wanted.items()}
    for r in got.collect():  # one row per shingle of the block at most
        out[r["n"]][r["at"]] = r["c"]
    return out


def _find(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``values`` in sorted ``keys``, and which are there."""
    place = np.searchsorted(keys, values)
    place[place == len(keys)] = 0
    return place, (keys[place] == values if len(keys) else np.zeros(len(values), bool))


def _prefixes(windows: Windows, counts: dict[int, np.ndarray], wanted: dict[int, np.ndarray]) -> dict[int, tuple]:
    """By shingle length: sorted prefix shingles, and for each the windows and the shingle's place in them."""
    rows: dict[int, list[tuple]] = {}
    for n, by_window in windows.shingles().items():
        for i, h in by_window.items():
            freq = counts[n][np.searchsorted(wanted[n], h)]
            if freq.min() == 0:  # a shingle that no text holds: the window occurs nowhere
                continue
            rarest = int(np.lexsort((h, freq))[0])
            rows.setdefault(n, []).append((int(h[rarest]), i, rarest))
    out = {}
    for n, r in rows.items():
        r.sort()
        key = np.array([x[0] for x in r], np.uint64)
        uniq, first, many = np.unique(key, return_index=True, return_counts=True)
        out[n] = (uniq, first, many, np.array([x[1] for x in r]), np.array([x[2] for x in r]))
    return out


def _matches(h: np.ndarray, row: np.ndarray, prefixes: dict, flat: np.ndarray, begin: np.ndarray,
             length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and window of every occurrence of a window in the texts of a batch."""
    at_all, win_all = [], []
    for n, (uniq, first, many, window, shift) in prefixes.items():
        g, at = ngrams(h, n, row)
        place, found = _find(uniq, g)
        place, at = place[found], at[found]
        k = many[place]
        at = np.repeat(at, k)
        entry = np.repeat(first[place], k) + np.arange(len(at)) - np.repeat(np.cumsum(k) - k, k)
        win = window[entry]
        start = at - shift[entry]
        end = start + length[win] - 1
        ok = (start >= 0) & (end < len(h))  # positional and length bounds
        at, win, start, end = at[ok], win[ok], start[ok], end[ok]
        ok = (row[start] == row[at]) & (row[end] == row[at])
        win, start = win[ok], start[ok]
        for lo in range(0, len(win), 1 << 16):
            w, s = win[lo:lo + (1 << 16)], start[lo:lo + (1 << 16)]
            size = length[w]
            step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            same = h[np.repeat(s, size) + step] == flat[np.repeat(begin[w], size) + step]
            ok = np.logical_and.reduceat(same, np.cumsum(size) - size)
            at_all.append(s[ok])
            win_all.append(w[ok])
    if not at_all:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(at_all), np.concatenate(win_all)


def _held_against(docs: DataFrame, benchmark: DataFrame, keep: list[str], window: int, block: int) -> DataFrame:
    """``kept_columns``, n_words, the hit words and the items of every row."""
    items = stage(_hash_items(benchmark), "items")
    n_windows = items.agg(F.sum("n_windows")).first()[0] or 0
    n_blocks = max(1, -(-n_windows // block))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept_columns"),
                       F.coalesce(F.col("`text`"), F.lit("")).cast("binary").alias("text"),
                       F.lit(None).cast("long").alias("n_words"), F.lit(None).cast("array<long>").alias("hit"),
                       F.lit(None).cast("array<string>").alias("items"))
    for b in range(n_blocks):
        found = Windows(_items(items, n_blocks, b), window)  # about ``block`` windows
        wanted = {n: np.unique(np.concatenate(list(w.values()))) for n, w in found.shingles().items()}
        counts = _count(rows, wanted) if wanted else {}
        rows = _against(rows, found, _prefixes(found, counts, wanted))
    return rows


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    rows = _held_against(docs, benchmark, ["doc_id"], window, block)
    return rows.select(F.col("kept_columns.doc_id").cast("long").alias("doc_id"), "n_words", F.size("hit").cast("long").alias("n_hit"),
                       F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                       (F.size("hit") > 0).alias("contaminated"))


def clean_rows(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that no window occurs in, with all their columns."""
    rows = _held_against(docs, benchmark, docs.columns, window, block)
    return rows.where(F.size("hit") == 0).select("kept_columns.*")


def _against(rows: DataFrame, found: Windows, prefixes: dict) -> DataFrame:
    """Adds the occurrences of a block's windows to the hit words and items of each row."""
    length = found.length
    flat = np.concatenate(found.words) if found.words else np.zeros(0, np.uint64)
    model = rows.sparkSession.sparkContext.broadcast(
        (prefixes, flat, np.cumsum(length) - length, length, found.ids))  # a block's windows at most

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefix, flat, begin, length, ids = model.value
        for batch in batches:
            for part in slices(batch):
                n = part.num_rows
                data, off = buffers(part.column(1))
                h, s, _ = words(data, off, _LUT)
                row = row_of(s, off)
                start, win = _matches(h, row, prefix, flat, begin, length)
                hit = part.column(3).to_pylist()
                items = part.column(4).to_pylist()
                hit, items = [x or [] for x in hit], [x or [] for x in items]
                word0 = np.searchsorted(row, np.arange(n))
                mark = np.zeros(len(h), bool)
                size = length[win]
                step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
                mark[np.repeat(start, size) + step] = True
                where = np.flatnonzero(mark)
                cuts = np.searchsorted(where, np.append(word0, len(h)))
                for i in np.unique(row[start]).tolist():
                    new = (where[cuts[i]:cuts[i + 1]] - word0[i]).tolist()
                    hit[i] = sorted({*hit[i], *new}) if hit[i] else new
                order = np.argsort(row[start], kind="stable")
                for i, w in zip(row[start][order].tolist(), win[order].tolist()):
                    if ids[w] is not None:
                        items[i].append(ids[w])
                items = [sorted(set(x)) if x else x for x in items]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(np.bincount(row, minlength=n)),
                     pa.array(hit, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))],
                    schema=part.schema.set(2, pa.field("n_words", pa.int64())))

    return map_arrow(rows, hold, rows.schema)
