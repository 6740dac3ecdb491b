"""Line deduplication by winnowing over line hashes.

A text is a sequence of lines; blank ones are skipped, white space at a line's
ends doesn't count. A window is a run of lines with ``MIN_WORDS`` words or more
that no longer has as many without its last line (or, looked at from the end,
without its first). Of each window the line with the smallest hash is selected
(the last of equal ones); a fingerprint is a selected line's hash and position,
once for all windows that select it. Two texts with a common run of ``MIN_WORDS``
words share a window, which selects the same line in both, so they are
guaranteed to share a fingerprint's hash. Positions are joined on that hash:
a fingerprint that is met at one position of the corpus only can't be part of a
repeated run, and its windows go no further.

At positions that share a fingerprint, windows with equal lines are joined to
the first text (smallest id, then place) that has them; each match is extended
both ways line by line along both texts, and the later run is deleted. All
windows of a common run that the shared fingerprints stand for take part,
whichever text comes first for each, so a run is deleted from end to end even if
its parts were first seen in different texts.

Within one text the later copy of a repeated run is deleted likewise. Blank
lines inside a deleted run go with it. Texts that keep no line come out empty.
A null text stays null and has no lines; null ids come after all others. Rows
equal in id and text are one text and come out equal. Other columns are
untouched by ``dedup_rows`` and left out by ``dedup_lines``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyscore.llm.common import map_arrow, mix, rows_per_task, slices, stage

MIN_WORDS = 50
_SPACE = b" \t\n\r\x0b\x0c"
_COEF = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def line_table(text: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """All lines; of the non-blank ones the numbers, hashes and word counts."""
    lines = text.split(b"\n")
    number, hashes, count = [], [], []
    for i, line in enumerate(lines):
        n = len(line.split())
        if n:
            number.append(i)
            hashes.append(xxhash.xxh3_64_intdigest(line.strip(_SPACE)))
            count.append(n)
    return lines, np.array(number, np.int64), np.array(hashes, np.uint64), np.array(count, np.int64)


def windows(hashes: np.ndarray, count: np.ndarray, least: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """First and last line of every window (distinct), seen from either end."""
    total = np.concatenate(([0], np.cumsum(count)))
    n = len(count)
    first = np.arange(n)
    last = np.searchsorted(total, total[:-1] + least, "left") - 1
    ahead = last < n
    end = np.arange(n)
    begin = np.searchsorted(total, total[1:] - least, "right") - 1
    back = begin >= 0
    both = np.unique(np.concatenate([np.stack([first[ahead], last[ahead]], 1),
                                     np.stack([begin[back], end[back]], 1)]), axis=0)
    return both[:, 0], both[:, 1]


def fingerprints(hashes: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each window the line selected, that is the last one with the smallest hash, and the hash of its lines in order."""
    size = last - first + 1
    step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    at = np.repeat(first, size) + step
    begin = np.cumsum(size) - size
    if not len(size):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least = np.repeat(np.minimum.reduceat(hashes[at], begin), size)
    selected = np.maximum.reduceat(np.where(hashes[at] == least, at, -1), begin)
    with np.errstate(over="ignore"):
        turn = _COEF[step & 63] * (step.astype(np.uint64) * np.uint64(2) + np.uint64(1))
        content = np.add.reduceat(hashes[at] * turn, begin)
        return selected, mix(content + size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def extend(later: np.ndarray, earlier: np.ndarray, first: int, last: int, shift: int) -> tuple[int, int]:
    """The longest run around ``first`` to ``last`` of ``later`` whose lines equal those of ``earlier``, ``shift`` before."""
    lo, hi = max(0, shift), min(len(later), len(earlier) + shift)
    same = later[lo:hi] == earlier[lo - shift:hi - shift]
    differ = np.flatnonzero(~same) + lo
    at = int(np.searchsorted(differ, first))
    left = int(differ[at - 1]) + 1 if at else lo
    at = int(np.searchsorted(differ, last))
    right = int(differ[at]) - 1 if at < len(differ) else hi - 1
    return left, right


def _keyed(docs: DataFrame) -> DataFrame:
    """A text's place in the order of texts (no_id, id, hash) and its bytes."""
    return docs.select(F.col("doc_id").isNull().alias("no_id"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
                       F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("th"),
                       F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))


def _fingerprint_rows(texts: DataFrame, least: int) -> DataFrame:
    """One row per fingerprint: its text, hash and line, and the windows that select it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                out: list[list] = [[], [], [], [], [], []]
                for i, text in enumerate(part.column(3).to_pylist()):
                    _, _, hashes, count = line_table(text)
                    if count.sum() < least:
                        continue
                    first, last = windows(hashes, count, least)
                    selected, content = fingerprints(hashes, first, last)
                    order = np.argsort(selected, kind="stable")
                    for x, y in zip(out, (np.full(len(first), i), selected[order], hashes[selected[order]].view(np.int64),
                                          first[order], last[order], content[order].view(np.int64))):
                        x.append(y)
                if out[0]:
                    row, at, fp, first, last, content = (np.concatenate(x) for x in out)
                    new = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (at[1:] != at[:-1]))))
                    spots = pa.StructArray.from_arrays(
                        [pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)), pa.array(content)],
                        ["first", "last", "content"])
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(c).take(pa.array(row[new])) for c in (0, 1, 2)), pa.array(fp[new]),
                         pa.array(at[new].astype(np.int32)),
                         pa.ListArray.from_arrays(pa.array(np.append(new, len(row)).astype(np.int32)), spots)],
                        ["no_id", "id", "th", "fp", "at", "spots"])

    return map_arrow(texts, run, "no_id boolean, id long, th long, fp long, at int, "
                     "spots array<struct<first:int,last:int,content:long>>")


def shared_windows(texts: DataFrame, least: int) -> DataFrame:
    """The windows of the fingerprints whose hash is met at more than one position: no_id, id, th, fp, first, last, content."""
    prints = stage(_fingerprint_rows(texts, least), "fingerprints")
    again = prints.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("fp")
    return prints.join(again, "fp", "left_semi").select("no_id", "id", "th", "fp", F.inline("spots"))


def _line_hashes(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array([line_table(t)[2].tobytes() for t in part.column(3).to_pylist()], pa.binary())],
                    ["no_id", "id", "th", "lines"])

    return map_arrow(texts, run, "no_id boolean, id long, th long, lines binary")


def repeated_runs(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """For each text (no_id, id, th) with a later run: its runs as arrays of first and last lines."""
    texts = _keyed(docs)
    prints = stage(shared_windows(texts, least), "windows")
    key = ["fp", "content"]
    place = F.struct("no_id", "id", "th", "first")
    seen = (prints.groupBy(*key).agg(F.min(place).alias("o"), F.max(place).alias("z"))
            .where("o <> z").select(*key, F.col("o.no_id").alias("o_no_id"), F.col("o.id").alias("o_id"),
                                    F.col("o.th").alias("o_th"), F.col("o.first").alias("o_first")))
    seen = stage(seen, "first-places")
    later = (prints.join(seen, key)
             .where("not (no_id = o_no_id and id = o_id and th = o_th and first = o_first)"))
    own = "no_id = o_no_id and id = o_id and th = o_th"
    later = stage(later.withColumn("shift", F.col("first") - F.col("o_first"))
                  .groupBy("no_id", "id", "th", "o_no_id", "o_id", "o_th", F.when(F.expr(own), F.col("first")).alias("own"), "shift")
                  .agg(F.min("first").alias("first"), F.max("last").alias("last"),
                       F.collect_set(F.when(~F.expr(own), F.struct("first", "last"))).alias("seeds")), "matches")
    inside = later.where("own is not null").select("no_id", "id", "th", "first", "last")
    # the text itself is dropped: only its line hashes are needed to extend a match
    lines = stage(_line_hashes(texts), "line-hashes").dropDuplicates(["no_id", "id", "th"])
    # a hot passage's first text serves many later ones: it goes to as many parts as ask for it
    mine, theirs = ["no_id", "id", "th"], ["o_no_id", "o_id", "o_th"]
    asks = later.where("own is null").select(*mine, *theirs, "shift", "seeds", F.pmod(
        F.xxhash64(*mine), F.lit(rows_per_task(docs))).alias("part"))
    other = (asks.select(*theirs, "part").distinct()
             .join(lines.select(*[F.col(c).alias(o) for c, o in zip(mine, theirs)], F.col("lines").alias("o_lines")), theirs))
    both = (asks.join(lines, mine).join(other, [*theirs, "part"])
            .select("no_id", "id", "th", "shift", "seeds", "lines", "o_lines"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, first, last = [], [], []
            for i, (shift, seeds, a, b) in enumerate(zip(*(batch.column(c).to_pylist() for c in (3, 4, 5, 6)))):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                reach = -1
                for seed in sorted(seeds, key=lambda x: (x["first"], x["last"])):
                    if seed["last"] <= reach:
                        continue
                    left, reach = extend(a, b, seed["first"], seed["last"], shift)
                    row.append(i)
                    first.append(left)
                    last.append(reach)
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(at) for c in (0, 1, 2)), pa.array(first, pa.int32()), pa.array(last, pa.int32())],
                ["no_id", "id", "th", "first", "last"])

    found = map_arrow(both, run, "no_id boolean, id long, th long, first int, last int").unionByName(inside).distinct()
    return found.groupBy("no_id", "id", "th").agg(F.collect_list(F.struct("first", "last")).alias("runs"))


def remove_runs(text: bytes, runs: list[tuple[int, int]]) -> tuple[bytes, int]:
    """The text without the runs of non-blank lines, and the number of lines deleted (blank ones not counted)."""
    lines, number, _, _ = line_table(text)
    gone = np.zeros(len(number) + 1, np.int64)
    inside = np.zeros(len(lines) + 1, np.int64)
    for a, b in runs:
        gone[a] += 1
        gone[b + 1] -= 1
        inside[number[a]] += 1
        inside[number[b] + 1] -= 1
    deleted = int((np.cumsum(gone)[:-1] > 0).sum())
    inside = np.cumsum(inside)[:-1] > 0
    if deleted == len(number):
        return b"", deleted
    return b"\n".join(line for line, x in zip(lines, inside) if not x), deleted


def dedup_rows(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """Every row with all its columns in ``original``, its new text, n_lines and n_deleted."""
    runs = repeated_runs(docs, least).select(F.col("no_id").alias("r_no_id"), F.col("id").alias("r_id"),
                                             F.col("th").alias("r_th"), "runs")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("original"),
                       F.col("doc_id").isNull().alias("no_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
                       F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("th"),
                       F.col("text").cast("binary").alias("bytes"))
    both = (rows.join(runs, (F.col("no_id") == F.col("r_no_id")) & (F.col("id") == F.col("r_id")) & (F.col("th") == F.col("r_th")), "left")
            .select("original", "bytes", "runs"))
    schema = both.select("original").schema.add("text", "binary").add("n_lines", "long").add("n_deleted", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_lines, deleted = [], [], []
            for text, runs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                n_lines.append(0 if text is None else sum(1 for x in text.split(b"\n") if x.split()))
                if text is None or not runs:
                    texts.append(text)
                    deleted.append(0)
                    continue
                new, n = remove_runs(text, [(r["first"], r["last"]) for r in runs])
                texts.append(new)
                deleted.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.binary()), pa.array(n_lines, pa.int64()), pa.array(deleted, pa.int64())],
                ["original", "text", "n_lines", "n_deleted"])

    return (map_arrow(both, run, schema)
            .select("original", F.col("text").cast("string").alias("text"), "n_lines", "n_deleted"))


def dedup_lines(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """Per row: doc_id, text without later repeated runs, n_lines, n_deleted."""
    return dedup_rows(docs.select("doc_id", "text"), least).select(
        F.col("original.doc_id").cast("long").alias("doc_id"), "text", "n_lines", "n_deleted")
