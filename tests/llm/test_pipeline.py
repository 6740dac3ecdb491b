"""The pipeline's stages on the small tables: columns, effects and whole results."""

import corpus_pipeline
import edge

import __spark_entry__


def test_stages_keep_the_columns_and_pack_everything(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    seen = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_small)
        assert out.columns == docs.columns, name
        docs = corpus_pipeline.stage(out, "test")
        seen.append(docs.count())
    assert seen == sorted(seen, reverse=True) and seen[-1] > seen[0] / 2
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_small)
    assert packed.select("doc_id").distinct().count() == docs.count()
    assert corpus_pipeline.run(spark, sf_small).count() == packed.count()


def test_stages_on_odd_rows(spark, sf_small):
    docs = edge.documents(spark)
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_small).collect()
        stage(spark, docs.where("false"), sf_small).collect()


def test_registered():
    names = set(__spark_entry__.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
