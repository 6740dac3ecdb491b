"""Per-key files: a key may fill several files, earlier batches stay."""

import glob
import gzip
import threading

import pytest
from pyspark.sql import functions as F

from polyscore.operators import sinks
from polyscore.plans import export as ex


def test_large_key_is_split_and_sorted(spark, tmp_path):
    df = spark.range(20_000).select(F.when(F.col("id") < 19_000, "big").otherwise("small").alias("k"),
                                    ((F.col("id") * 7919) % 20_000).alias("pos"))
    # AQE would merge partitions as small as these
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_per_key(df, str(tmp_path / "o"), "k", sort_by=["pos"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted(glob.glob(str(tmp_path / "o" / "k=big" / "*.csv.gz")))
    assert len(files) > 1
    pos = [int(x) for f in files for x in gzip.open(f, "rt").read().split()[1:]]
    assert pos == sorted(pos) and len(pos) == 19_000


def test_wide_export_computes_rows_once_and_keeps_batches(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    cols = ["pheno_id", "pop_set", "chr", "pos", *ex.export_columns("quant", ex.POPS)[2:]]
    rows = [(f"p{i % 2}", "EUR" if i % 2 else "AFR-EUR", "1", i) for i in range(10)]
    base = spark.createDataFrame(rows, "pheno_id string, pop_set string, chr string, pos int")
    wide = base.select(*base.columns, *[F.lit("x").alias(c) for c in cols[4:] if c not in base.columns])
    wide = wide.mapInArrow(count, wide.schema)
    first = ex.write_wide_exports(wide, str(tmp_path / "w"), "quant")
    assert seen.value == 10
    second = ex.write_wide_exports(wide, str(tmp_path / "w"), "quant")
    assert len(first) == len(second) == 2 and not set(first) & set(second)
    for path in first + second:
        assert spark.read.option("header", True).option("sep", "\t").csv(path).count() == 5


def test_writers_at_once_get_different_batches(spark, tmp_path):
    path = str(tmp_path / "b")
    got = []
    threads = [threading.Thread(target=lambda k=k: got.append(sinks.append_batch(spark.range(k * 100, k * 100 + 100), path)))
               for k in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(got) == [1, 2, 3, 4]
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(400))
    assert {r.batch for r in spark.read.parquet(path).select("batch").distinct().collect()} == {1, 2, 3, 4}


def test_an_abandoned_claim_is_seen_skipped_and_taken_over(spark, tmp_path):
    path = str(tmp_path / "b")
    assert sinks.append_batch(spark.range(5), path) == 1

    def fail(work):
        spark.range(3).write.parquet(work)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        sinks.publish_batch(spark, path, fail, "batch=")
    assert sinks.abandoned_batches(spark, path, "batch=") == [2]
    assert spark.read.parquet(path).count() == 5  # nothing of the lost writer shows
    assert sinks.append_batch(spark.range(7), path) == 3
    assert sinks.append_batch(spark.range(2), path, stale_after=3600) == 4  # too young to be taken over
    assert sinks.append_batch(spark.range(11), path, stale_after=0) == 2
    assert sinks.abandoned_batches(spark, path, "batch=") == []
    assert spark.read.parquet(path).count() == 5 + 7 + 2 + 11
