"""Toxicity by FTRL-proximal logistic regression over hashed n-grams and skip-grams.

A text's features are its distinct words, pairs of neighbours and pairs one word
apart (lower case, letters and digits), hashed into ``1 << BITS`` places. The
model is trained online, text by text, with a learning rate per coordinate, and
the L1 term keeps most weights exactly zero, so the model is a short list of
places and weights that every task can hold.

Training uses a bounded sample (``MAX_ROWS``) of the labelled rows outside the
held-out fold, chosen by hash, so it runs as one task of bounded size; scoring
runs over all rows. A text's labels, language, source and id never enter its
score.

A null text is empty; an empty text gets the score of the bias alone. Rows
without a label, or with a null one, aren't trained on; a document with two
labels counts as toxic if any says so. Without labelled rows all scores are 0.
Columns other than doc_id and text are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyscore.llm.common import alnum_lut, buffers, map_arrow, ngrams, row_of, slices, stage, words

BITS = 22
MAX_ROWS = 20_000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 2.0, 1.0, 12.0, 1.0
_LUT = alnum_lut()


def features(column: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Place and row of every word, pair and skip-pair (with repeats)."""
    data, off = buffers(column)
    h, s, _ = words(data, off, _LUT)
    row = row_of(s, off)
    pair, at = ngrams(h, 2, row)
    out, rows = [h, pair], [row, row[at]]
    if len(h) > 2:
        at = np.flatnonzero(row[:-2] == row[2:])
        with np.errstate(over="ignore"):
            out.append(ngrams(np.stack([h[at], h[at + 2]], 1).reshape(-1), 2, np.repeat(np.arange(len(at)), 2))[0]
                       * np.uint64(0xC2B2AE3D27D4EB4F))
        rows.append(row[at])
    places = (np.concatenate(out) >> np.uint64(64 - bits)).astype(np.int64)
    return places, np.concatenate(rows)


def train(examples: list[np.ndarray], labels: np.ndarray, bits: int = BITS, epochs: int = EPOCHS, alpha: float = ALPHA,
          beta: float = BETA, l1: float = L1, l2: float = L2) -> tuple[np.ndarray, np.ndarray, float]:
    """FTRL-proximal over the examples in order; the places and weights that aren't zero, and the bias.

    ``examples`` are the distinct places of each text.
    """
    size = 1 << bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(at):
        zi = z[at]
        w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        w[np.abs(zi) <= l1] = 0.0
        return w

    for _ in range(epochs):
        for at, y in zip(examples, labels):
            at = np.append(at, size)
            w = weights(at)
            w[-1] = -z[size] / ((beta + np.sqrt(n[size])) / alpha + l2)  # the bias has no L1 term
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            if abs(g) < 1e-6:
                continue
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    at = np.flatnonzero(np.abs(z[:size]) > l1)
    return at, weights(at), float(-z[size] / ((beta + np.sqrt(n[size])) / alpha + l2))


def labelled(labels: DataFrame, folds: int, most: int) -> DataFrame:
    """At most ``most`` labelled ids outside fold 0, chosen by hash."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds))
    return (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (fold != 0))
            .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, most: int = MAX_ROWS, bits: int = BITS,
        **options) -> tuple[np.ndarray, np.ndarray, float]:
    chosen = stage(labelled(labels, folds, most), "toxic-sample")
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .join(F.broadcast(chosen), "doc_id")  # ``most`` ids at most
            .select("doc_id", F.col("toxic").cast("int").alias("toxic"),
                    F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                place, row = features(part.column(2), bits)
                order = np.argsort(row, kind="stable")
                cut = np.searchsorted(row[order], np.arange(part.num_rows + 1))
                sets = [np.unique(place[order[a:b]]).astype(np.int32).tobytes() for a, b in zip(cut[:-1], cut[1:])]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sets, pa.binary())],
                                                 ["doc_id", "toxic", "places"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, y, sets = [], [], []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            y += batch.column(1).to_pylist()
            sets += batch.column(2).to_pylist()
        if not ids:
            return
        last = {d: i for i, d in enumerate(ids)}  # repeated rows of a document are one example
        picked = sorted(last.values(), key=lambda i: (ids[i] * 0x9E3779B97F4A7C15 & (1 << 64) - 1, ids[i]))
        at, w, bias = train([np.frombuffer(sets[i], np.int32).astype(np.int64) for i in picked],
                            np.array([y[i] for i in picked], float), bits, **options)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(w, bias))], ["place", "weight"])

    sample = map_arrow(rows, extract, "doc_id long, toxic int, places binary")
    model = map_arrow(sample.repartition(1), learn, "place long, weight double").collect()  # a bounded sample's model
    pairs = sorted((r["place"], r["weight"]) for r in model)
    if not pairs:
        return np.zeros(0, np.int64), np.zeros(0), float("-inf")
    return np.array([p for p, _ in pairs[1:]], np.int64), np.array([w for _, w in pairs[1:]]), pairs[0][1]


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], bits: int = BITS) -> DataFrame:
    """Per row: doc_id, score (0 to 1)."""
    places, weights, bias = model
    held = docs.sparkSession.sparkContext.broadcast((places, weights, bias))  # the non-zero weights of a bounded sample

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, weights, bias = held.value
        mark = np.zeros(1 << bits, bool)
        mark[places] = True
        for batch in batches:
            for part in slices(batch):
                n = part.num_rows
                place, row = features(part.column(1), bits)
                hit = mark[place]
                both = np.unique(row[hit] << bits | place[hit])
                w = weights[np.searchsorted(places, both & ((1 << bits) - 1))] if len(both) else np.zeros(0)
                x = bias + np.bincount(both >> bits, weights=w, minlength=n)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(1 / (1 + np.exp(-np.clip(x, -700, 700))))],
                                                 ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    return map_arrow(rows, apply, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, **options) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds)) == 0, F.lit(False))
    return score(docs, fit(docs, labels, folds, **options)).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
