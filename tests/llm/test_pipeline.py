"""The pipeline's stages on odd tables, and its run over the smallest input."""

import os

import corpus_pipeline
import pytest
from millrace.llm import language, toxicity

DATA = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_of_documents(spark, docs, edges, tmp_path):
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(60)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for df in (docs, edges):
        d = df.select("doc_id", "text", "lang", "source", "n_chars")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, d, str(tmp_path))
            assert out.columns == d.columns, name
            out.collect()


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")
def test_run(spark):
    rows = corpus_pipeline.run(spark, DATA).collect()
    assert rows and {"shard", "bin", "at", "doc_id", "start", "length"} <= set(rows[0].asDict())


def test_training_leaves_no_files(spark, docs, tmp_path, monkeypatch):
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(60)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    given = []
    for m in (language, toxicity):
        monkeypatch.setattr(m, "shared_dir", lambda spark, name: given.append(tmp_path / "shared" / name) or f"file://{given[-1]}")
    for _, stage in corpus_pipeline.STAGES[:2]:
        assert stage(spark, docs.select("doc_id", "text", "lang", "source", "n_chars"), str(tmp_path)).count()
    assert [p.name for p in given] == ["language", "toxicity"]
    assert (tmp_path / "shared").exists() and not [p for p in given if p.exists()]
