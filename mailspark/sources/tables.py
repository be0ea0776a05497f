"""Labelled corpora held as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailspark.sources.mails import label_name


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(table: DataFrame, *keys: str) -> DataFrame:
    """A scanned table, repartitioned only when it has fewer splits than there are cores.

    Long texts in a few big row groups would otherwise be worked on by few tasks;
    a table of many files is left as it is.
    """
    if table.rdd.getNumPartitions() >= table.sparkSession.sparkContext.defaultParallelism:
        return table
    return table.repartition(*keys)


def labelled_documents(spark: SparkSession, folder: str, target: str = "toxic") -> DataFrame:
    """``documents`` with a label as mail records; ``target`` names the 0/1 label."""
    documents = spread(
        read_table(spark, folder, "documents").select("doc_id", "text", "source"), "doc_id"
    )
    labels = read_table(spark, folder, "labels").select(
        "doc_id", F.col(target).cast("int").alias("label")
    )
    return (
        documents.join(labels, "doc_id")
        .where(F.col("text").isNotNull() & F.col("label").isNotNull())
        .select(
            F.sha1(F.col("doc_id").cast("string").cast("binary")).alias("id"),
            "label",
            label_name(F.col("label")).alias("label_name"),
            "text",
            F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("path"),
        )
    )
