"""Quality rules: divergence of a document's histograms from its language's.

A document's characters are counted by class and its words by the most common
words of its language; both histograms are held against the same histograms of
all documents of that language with the Jensen-Shannon distance (base 2, its
square root, 0 to 1). Short documents have noisy histograms, so each test has a
minimum length. Base rules (length, repetition) go first.

The references are counted over all documents that pass the base rules, one for
each language, and joined to the documents by language. A language's verdicts
depend on its own documents only. Below LEAST_WORDS words a reference is too
noisy: both tests abstain, the distances are null and the base rules decide.

A null text has no words and fails the base rules, as does an empty one. A null
language is a language of its own. Rows are judged one by one, so ties and
repeated rows get equal results. Columns other than doc_id, text and lang are
left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from polyscore.llm.common import buffers, map_arrow, ngrams, row_of, rows_per_task, slices, space_lut, stage, texts_of, words

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Distances above these fail; lengths in words below which a test isn't made.
MAX_CLASS, MIN_CLASS_WORDS = 0.30, 50
MAX_WORD, MIN_WORD_WORDS = 0.39, 70
COMMON = 48
#: Words of a language below which it has no reference. Drawn from sf0.1, references of 10,000 words fail 0.02% of
#: other good documents of their language at most (mean of five draws), those of 5,000 words up to 1.8%.
LEAST_WORDS = 10_000
_TALLY = 2_000_000

_CLASSES = 8
_CLASS = np.full(256, 7, np.uint8)  # bytes that continue a character
_CLASS[0:128] = 6                    # other ASCII
_CLASS[97:123] = 0
_CLASS[65:91] = 1
_CLASS[48:58] = 2
_CLASS[[32, 9, 10, 11, 12, 13]] = 3
_CLASS[[33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63]] = 4
_CLASS[192:256] = 5                  # the first byte of a character beyond ASCII
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_EXACT, _LOWER = space_lut(False), space_lut(True)


class Features:
    """Counts of every text of a batch, as arrays."""

    def __init__(self, column: pa.Array):
        data, off = buffers(column)
        n = len(column)
        self.words, start, _ = words(data, off, _EXACT)
        self.row = row_of(start, off)
        self.n_words = np.bincount(self.row, minlength=n)
        char_row = np.repeat(np.arange(n), np.diff(off))
        cls = _CLASS[data]
        self.classes = np.bincount(char_row * _CLASSES + cls, minlength=n * _CLASSES).reshape(n, _CLASSES)
        self.word_chars = self.classes[:, :7].sum(1) - self.classes[:, 3]
        self.classes = self.classes[:, :7]
        self.n_symbols = np.bincount(char_row[_SYMBOL[data]], minlength=n)
        self.lower = words(data, off, _LOWER)[0]
        self.n_repeat = self._repeated(n)
        self.n_dup_lines = np.array(_repeated_lines(data.tobytes(), off), np.int64)
        self.failed = (self.n_words < MIN_WORDS) | (100 * self.n_repeat > MAX_REPEAT_PERCENT * self.n_words)

    def _repeated(self, n: int) -> np.ndarray:
        h, at = ngrams(self.words, 3, self.row)
        if not len(h):
            return np.zeros(n, np.int64)
        order = np.lexsort((h, self.row[at]))
        h, at, row = h[order], at[order], self.row[at][order]
        same = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
        twice = np.zeros(len(h), bool)
        twice[1:] |= same
        twice[:-1] |= same
        hit = np.zeros(len(self.words), bool)
        for j in range(3):
            hit[at[twice] + j] = True
        return np.bincount(self.row[hit], minlength=n)


def _repeated_lines(raw: bytes, off: np.ndarray) -> Iterator[int]:
    out = []
    for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
        lines = raw[a:b].split(b"\n")
        if len(set(lines)) == len(lines):
            out.append(0)
            continue
        lines = [x for x in lines if x.strip(b" \t\n\r\x0b\x0c")]
        out.append(len(lines) - len(set(lines)))
    return out


class _Tally:
    """Sums by 64-bit key, in arrays of bounded size before they are given out."""

    def __init__(self):
        self.keys, self.counts, self.size = [], [], 0

    def add(self, keys: np.ndarray) -> None:
        k, c = np.unique(keys, return_counts=True)
        self.keys.append(k)
        self.counts.append(c)
        self.size += len(k)

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        keys, inverse = np.unique(np.concatenate(self.keys), return_inverse=True)
        counts = np.bincount(inverse, weights=np.concatenate(self.counts)).astype(np.int64)
        self.keys, self.counts, self.size = [], [], 0
        return keys, counts


def _by_language(lang: pa.Array, row: np.ndarray) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray]]:
    """Each language of a batch, its rows, its words, and of each word the place of its row among those rows."""
    named = lang.dictionary_encode()
    code = named.indices.to_numpy().astype(np.int64)
    marks = np.arange(len(named.dictionary) + 1)
    rows = np.argsort(code, kind="stable")
    first = np.searchsorted(code[rows], marks)
    place = np.empty(len(code), np.int64)
    place[rows] = np.arange(len(code)) - first[code[rows]]
    of_word = code[row]
    at = np.argsort(of_word, kind="stable")
    cut = np.searchsorted(of_word[at], marks)
    for i, name in enumerate(named.dictionary.to_pylist()):
        mine = at[cut[i]:cut[i + 1]]
        yield name, rows[first[i]:first[i + 1]], mine, place[row[mine]]


def references(docs: DataFrame, common: int = COMMON, least: int = LEAST_WORDS) -> DataFrame:
    """A row for each language of ``least`` words or more: lang and ref (words, counts by class, most common words)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies: dict[str, _Tally] = {}
        classes: dict[str, np.ndarray] = {}

        def given() -> pa.RecordBatch:
            parts = []
            for lang, tally in tallies.items():
                k, c = tally.take()
                parts += [(lang, 1, k.view(np.int64), c), (lang, 0, np.arange(len(classes[lang])), classes[lang])]
            tallies.clear()
            classes.clear()
            return _rows(parts)

        size = 0
        for batch in batches:
            for part in slices(batch):
                x = Features(part.column(1))
                for lang, rows, at, _ in _by_language(part.column(0), x.row):
                    rows = rows[~x.failed[rows]]
                    if not len(rows):
                        continue
                    classes[lang] = classes.get(lang, 0) + x.classes[rows].sum(0)
                    tally = tallies.setdefault(lang, _Tally())
                    size -= tally.size
                    tally.add(x.lower[at[~x.failed[x.row[at]]]])
                    size += tally.size
                if size > _TALLY:  # of all languages together
                    yield given()
                    size = 0
        if tallies:
            yield given()

    rows = texts_of(docs.withColumn("lang", F.coalesce(F.col("lang"), F.lit(""))), "lang")
    counted = (map_arrow(rows, count, "lang string, kind int, key long, n long")
               .groupBy("lang", "kind", "key").agg(F.sum("n").alias("n")).persist())
    try:
        of_class = [F.sum(F.when((F.col("kind") == 0) & (F.col("key") == k), F.col("n")).otherwise(0)) for k in range(_CLASSES - 1)]
        sums = (counted.groupBy("lang").agg(F.sum(F.when(F.col("kind") == 1, F.col("n"))).alias("words"),
                                            F.array(*of_class).alias("classes")).where(F.col("words") >= least))
        part = F.pmod(F.xxhash64("key"), F.lit(rows_per_task(docs)))
        in_part = Window.partitionBy("lang", part).orderBy(F.desc("n"), "key")
        overall = Window.partitionBy("lang").orderBy(F.desc("n"), "key")
        top = (counted.where("kind = 1").withColumn("place", F.row_number().over(in_part)).where(F.col("place") <= common)
               .withColumn("place", F.row_number().over(overall)).where(F.col("place") <= common)
               .groupBy("lang").agg(F.collect_list(F.struct("key", "n")).alias("top")))  # common words a language
        return stage(sums.join(top, "lang").select("lang", F.struct("words", "classes", "top").alias("ref")), "references")
    finally:
        counted.unpersist()


def _rows(parts: list[tuple[str, int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    lang, kind, key, n = zip(*parts)
    at = np.repeat(np.arange(len(parts)), [len(k) for k in key])
    return pa.RecordBatch.from_arrays(
        [pa.array(lang, pa.string()).take(pa.array(at)), pa.array(np.array(kind, np.int32)[at]),
         pa.array(np.concatenate(key)), pa.array(np.concatenate(n))],
        ["lang", "kind", "key", "n"])


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Rows of ``p`` against ``q`` (shares)."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p > 0, p * np.log2(p / m), 0).sum(1)
        b = np.where(q > 0, q * np.log2(q / m), 0).sum(1)
    return np.sqrt(np.clip((a + b) / 2, 0, 1))


def _shares(ref: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class shares, the common words in order, and their shares with that of all other words at the end."""
    keys = np.array([r["key"] for r in ref["top"]], np.int64).view(np.uint64)
    order = np.argsort(keys)
    share = np.array([r["n"] for r in ref["top"]], float) / ref["words"]
    cls = np.array(ref["classes"], float)
    return cls / max(cls.sum(), 1), keys[order], np.append(share[order], max(0.0, 1 - share.sum()))


def distances(x: Features, lang: pa.Array, refs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Both distances of each text from its language's reference, NaN where the language has none."""
    n = len(x.n_words)
    by_class, by_word = np.full(n, np.nan), np.full(n, np.nan)
    for _, rows, at, place in _by_language(lang, x.row):
        ref = refs[int(rows[0])].as_py()
        if ref is None:
            continue
        classes, common, shares = _shares(ref)
        total = x.classes[rows].sum(1, keepdims=True)
        by_class[rows] = js_distance(x.classes[rows] / np.maximum(total, 1), classes[None, :])
        h, k = x.lower[at], len(common)
        slot = np.searchsorted(common, h)
        slot[slot == k] = 0
        slot = np.where(common[slot] == h, slot, k) if k else np.zeros(len(h), np.int64)
        counts = np.bincount(place * (k + 1) + slot, minlength=len(rows) * (k + 1)).reshape(len(rows), k + 1)
        by_word[rows] = js_distance(counts / np.maximum(counts.sum(1, keepdims=True), 1), shares[None, :])
    return by_class, by_word


def quality(docs: DataFrame, max_class: float = MAX_CLASS, max_word: float = MAX_WORD,
            common: int = COMMON, least: int = LEAST_WORDS) -> DataFrame:
    """Per row: doc_id, the base counts, both distances (null without a reference) and the verdict ``kept``."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                x = Features(part.column(2))
                by_class, by_word = distances(x, part.column(1), part.column(3))
                far = ((x.n_words >= MIN_CLASS_WORDS) & (by_class > max_class)
                       | (x.n_words >= MIN_WORD_WORDS) & (by_word > max_word))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(c.astype(np.int64)) for c in (
                        x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat)],
                     pa.array(by_class, from_pandas=True), pa.array(by_word, from_pandas=True), pa.array(x.failed), pa.array(~x.failed & ~far)],
                    ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                     "class_distance", "word_distance", "base_failed", "kept"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang"), F.lit("")).alias("lang"),
                       F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    rows = rows.join(references(docs, common, least), "lang", "left").select("doc_id", "lang", "text", "ref")
    return map_arrow(rows, judge, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                     "n_repeat_words long, class_distance double, word_distance double, base_failed boolean, kept boolean")
