"""Streams over tables kept as one file or as a folder of files."""

import pytest
from pyspark.sql import functions as F

from mailspark.operators.baselines import keyword_predictions
from mailspark.queries import streamed_keyword_scores
from mailspark.sources.scratch import scratch_path
from mailspark.streaming.score import score_stream, scored_rows, table_stream

ROWS = [(i, "win money now" if i % 3 == 0 else f"lunch at {i}", "s", "en", 1) for i in range(30)]
SCHEMA = "doc_id long, text string, source string, lang string, n_chars long"


@pytest.mark.parametrize("parts", [1, 3])
def test_folder_tables(spark, tmp_path, parts):
    table = spark.createDataFrame(ROWS, SCHEMA)
    table.repartition(parts).write.parquet(str(tmp_path / "documents.parquet"))
    found = {r["id"]: r["prediction"] for r in streamed_keyword_scores(spark, str(tmp_path)).collect()}
    ids = table.withColumn("id", F.sha1(F.col("doc_id").cast("string").cast("binary")))
    expected = {r["id"]: r["prediction"] for r in keyword_predictions(ids).collect()}
    assert found == expected and len(found) == len(ROWS)


def test_one_file(spark):
    found = streamed_keyword_scores(spark, "/root/testdata/sf0.001")
    assert found.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()


def test_nothing_has_come_in(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    table = spark.read.schema(SCHEMA).parquet(str(tmp_path / "documents.parquet"))
    rows = table.select(F.col("doc_id").alias("id"), "text")
    out = scratch_path(spark, "nothing")
    stream = table_stream(spark, str(tmp_path), "documents", table.schema)
    stream = stream.select(F.col("doc_id").alias("id"), "text")
    score_stream(stream, keyword_predictions, f"{out}/a", f"{out}/b").awaitTermination()
    found = scored_rows(spark, f"{out}/a", rows, keyword_predictions)
    assert found.collect() == [] and "prediction" in found.columns
