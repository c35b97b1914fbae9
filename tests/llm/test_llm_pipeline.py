"""The corpus pipeline and the registration of its queries."""

import corpus_pipeline
from pyspark.sql import functions as F

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def test_every_operator_has_a_query():
    names = entry.queries()
    assert all(sum(q.startswith(f"op{n}_") for q in names) == 1 for n in range(1, 11)) and "pipeline" in names


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    start = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF).cache()
        assert out.schema.simpleString() == start.schema.simpleString(), name
        assert out.count() <= docs.count()
        assert out.where(F.col("n_chars") != F.length("text")).count() == docs.where(F.col("n_chars") != F.length("text")).count() == 0
        docs = out
    assert docs.count() < start.count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    whole = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all"))
    assert whole.where("n <> all").count() == 0 and whole.count() == docs.count()


def test_run_is_the_stages_in_turn(spark):
    assert corpus_pipeline.run(spark, SF).agg(F.max("length")).first()[0] <= 2048
