import corpus_pipeline
from pyspark.sql import functions as F

from tests.llm.helpers import SF001, no_documents, odd_documents


def test_stages_on_the_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "pii", "mixing", "packing"]
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        new = spark.createDataFrame(stage(spark, left, SF001).collect(), docs.schema)
        assert new.columns == docs.columns
        if name in ("toxicity", "near_duplicates"):
            assert new.join(left, "doc_id", "left_anti").count() == 0 and new.count() == new.select("doc_id").distinct().count()
        if name == "pii":
            assert new.count() == left.count() and new.filter(F.length("text") != F.col("n_chars")).count() == 0
        left = new
    pieces = corpus_pipeline.STAGES[-1][1](spark, left, SF001)
    assert pieces.select("doc_id").distinct().count() == left.select("doc_id").distinct().count()


def test_run(spark):
    assert corpus_pipeline.run(spark, SF001).count() > 0


def test_odd_documents(spark):
    for docs in (odd_documents(spark), no_documents(spark)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF001)
            assert docs.isEmpty() == (out.count() == 0)
