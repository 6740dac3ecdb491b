"""Quality classifier by importance resampling.

Two generative models over hashed word n-grams (one bag of hashed unigrams and
bigrams each) are counted: one of the target, texts labelled good, one of the
raw corpus, all texts. A text's log importance weight is the sum of the log
ratios of its n-grams. Weights are taken per n-gram (with ``PRIOR`` neutral
n-grams added), so a text's length doesn't decide. ``k`` texts are then sampled
without replacement in proportion to the weights (to the power 1 / temperature)
by Gumbel top-k: noise drawn from the document id is added and the k largest
sums stay.

k isn't a given number: it is the number of texts whose weight reaches the
level that all but ``LOST`` of the labelled good texts reach which the target
model hasn't seen, so the sample grows with the good part of the input. The
k-th largest key is found by counting the keys of ever smaller ranges, so no
sort or collection of all keys is needed.

The target model is fitted on half of a bounded sample of labelled rows
(``MAX_TARGET``), the other half sets the level; the raw model counts all texts. A null text is empty
and has weight 0; the weight of an empty text is 0. Texts of equal key (repeated
rows) share one fate, so ties at the k-th place stay together. With no labels
all weights are 0. Columns other than doc_id and text are left out by
``weights`` and untouched by ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyscore.llm.common import buffers, map_arrow, mix, ngrams, row_of, slices, space_lut, stage, words

BUCKETS = 1 << 16
MAX_TARGET = 40_000
PRIOR = 20
LOST = 0.001
TEMPERATURE = 0.002
SEED = 7
_LUT = space_lut(False)


def _features(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every unigram and bigram."""
    data, off = buffers(column)
    h, s, _ = words(data, off, _LUT)
    row = row_of(s, off)
    pair, at = ngrams(h, 2, row)
    return (np.concatenate([h, pair]) % np.uint64(buckets)).astype(np.int64), np.concatenate([row, row[at]])


def target_ids(labels: DataFrame, most: int = MAX_TARGET) -> DataFrame:
    """Ids labelled good by all their rows, at most ``most``, chosen by hash; ``fit`` marks half of them."""
    good = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
            .agg(F.min("quality").alias("quality")).where("quality = 1").select("doc_id"))
    return (good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
            .withColumn("fit", F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(2)) == 0))


def log_ratios(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Smoothed log ratio of target to raw shares by bucket."""
    marked = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
              .join(F.broadcast(target.where("fit").select("doc_id", F.lit(True).alias("good"))), "doc_id", "left")  # MAX_TARGET ids at most
              .select(F.coalesce("good", F.lit(False)).alias("good"),
                      F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, good = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch):
                bucket, row = _features(part.column(1), buckets)
                raw += np.bincount(bucket, minlength=buckets)
                mark = part.column(0).to_numpy(zero_copy_only=False).astype(bool)
                good += np.bincount(bucket[mark[row]], minlength=buckets)
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(good[at])], ["bucket", "raw", "good"])

    counts = np.zeros((2, buckets))
    for r in (map_arrow(marked, count, "bucket long, raw long, good long").groupBy("bucket")
              .agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).collect()):  # one row per bucket
        counts[:, r["bucket"]] = r["raw"], r["good"]
    if not counts[1].any():
        return np.zeros(buckets)
    share = (counts + 1) / (counts.sum(1, keepdims=True) + buckets)
    return np.log(share[1] / share[0])


def _keyed(docs: DataFrame, ratios: np.ndarray, temperature: float, seed: int, keep: list[str]) -> DataFrame:
    """``keep`` columns, n_features, log_weight and the perturbed key of every row."""
    model = docs.sparkSession.sparkContext.broadcast(ratios)
    buckets = len(ratios)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                n = part.num_rows
                bucket, row = _features(part.column(part.schema.get_field_index("text")), buckets)
                size = np.bincount(row, minlength=n)
                weight = np.bincount(row, weights=model.value[bucket], minlength=n) / (size + PRIOR)
                ids = part.column(0).to_numpy(zero_copy_only=False)
                u = (mix(ids.astype(np.int64).view(np.uint64) ^ mix(np.array([seed], np.uint64))) >> np.uint64(11)) + 0.5
                gumbel = -np.log(-np.log(u / (1 << 53)))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:-1], pa.array(size), pa.array(weight),
                     pa.array(weight / temperature + gumbel)],
                    [*part.schema.names[1:-1], "n_features", "log_weight", "sample_key"])

    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("noise_id"), *keep,
                       F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    schema = docs.select(*keep).schema
    for name, kind in (("n_features", "long"), ("log_weight", "double"), ("sample_key", "double")):
        schema = schema.add(name, kind)
    return map_arrow(rows, score, schema)


def kth_largest(keys: DataFrame, k: int, digits: int = 4096) -> float:
    """The exact k-th largest value of ``sample_key`` by narrowing its range."""
    low, high = keys.agg(F.min("sample_key"), F.max("sample_key")).first()
    if low is None or k <= 0:
        return float("inf")
    above = 0  # values over ``high``
    while True:
        part = keys.where(F.col("sample_key").between(low, high))
        if low == high:
            return low
        width = (high - low) / digits
        if width <= abs(low) * 1e-15 or width == 0:
            values = [r[0] for r in part.groupBy("sample_key").count().select("sample_key", "count")
                      .orderBy(F.desc("sample_key")).limit(digits).collect() for _ in range(r[1])]
            return values[min(k - above, len(values)) - 1]
        slot = F.least(F.floor((F.col("sample_key") - F.lit(low)) / F.lit(width)), F.lit(digits - 1)).cast("int")
        rows = sorted(part.groupBy(slot.alias("slot")).agg(
            F.count(F.lit(1)).alias("n"), F.min("sample_key").alias("a"), F.max("sample_key").alias("b")).collect(),
            key=lambda r: -r["slot"])  # ``digits`` rows at most
        for r in rows:
            if above + r["n"] >= k:
                low, high = r["a"], r["b"]
                break
            above += r["n"]
        else:
            return low


def sample(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, temperature: float = TEMPERATURE,
           lost: float = LOST, seed: int = SEED) -> tuple[DataFrame, np.ndarray, float]:
    """Weights of all rows (staged: doc_id, n_features, log_weight, sample_key), the model and the least sampled key."""
    target = stage(target_ids(labels), "target")
    ratios = log_ratios(docs, target, buckets)
    keyed = stage(_keyed(docs, ratios, temperature, seed, ["doc_id"]), "importance")
    unseen = keyed.join(F.broadcast(target.where("not fit")), "doc_id")  # MAX_TARGET ids at most
    level = unseen.agg(F.percentile_approx("log_weight", lost, 100_000)).first()[0]
    k = keyed.where(F.col("log_weight") >= (float("-inf") if level is None else level)).count()
    return keyed, ratios, kth_largest(keyed, k)


def quality_weights(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, n_features, log_weight, sample_key, sampled."""
    keyed, _, least = sample(docs, labels, **options)
    return keyed.withColumn("sampled", F.col("sample_key") >= F.lit(least))


def keep(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The sampled rows of ``docs`` with all their columns."""
    _, ratios, least = sample(docs, labels, **options)
    names = docs.columns
    packed = docs.select(F.col("doc_id"), F.col("text"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("original"))
    keyed = _keyed(packed, ratios, options.get("temperature", TEMPERATURE), options.get("seed", SEED), ["original"])
    return keyed.where(F.col("sample_key") >= F.lit(least)).select("original.*")
