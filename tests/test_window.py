from pyspark.sql import Window
from pyspark.sql import functions as F

from polyscore.operators.reshape import add_dim_index
from polyscore.operators.window import rank_within


def test_rank_within_matches_row_number_on_skewed_key(spark):
    # one key holds most rows, spread over many tasks
    df = spark.range(0, 5000).select((F.when(F.col("id") % 10 < 7, 0).otherwise(F.col("id") % 10)).alias("k"),
                                     ((F.col("id") * 7919) % 1000).cast("double").alias("P"), F.col("id").alias("vid"))
    df = df.repartition(16)
    got = {(r.k, r.vid): r.idx for r in rank_within(df, ["k"], ["P", "vid"]).collect()}
    w = Window.partitionBy("k").orderBy("P", "vid")
    want = {(r.k, r.vid): r.idx for r in df.withColumn("idx", F.row_number().over(w) - 1).collect()}
    assert got == want


def test_add_dim_index_is_dense(spark):
    df = spark.range(0, 1000).select((F.col("id") * 37 % 1000).alias("x")).repartition(7)
    idx = sorted((r.x, r.idx) for r in add_dim_index(df, ["x"]).collect())
    assert [i for _, i in idx] == list(range(1000))
