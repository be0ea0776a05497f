"""Documents to training sequences: language, copies, near copies, secrets, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as
Parquet and read again as the next stage's docs.  All but the last return the columns of
documents.

The first stage writes the language that it finds into ``lang``, so the column is filled and
right for what follows, and rejects documents in which it finds none.

Rows: a document without a letter is rejected by the first stage, so null and empty texts
go; null ids count as larger than any other where one document of a group stays; rows
that repeat an id are documents of their own unless they repeat the text too, then one
stays; empty tables pass through all stages; further columns are passed on, whatever
their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mailspark.llm.common import hex_sha256
from mailspark.llm.exact_dedup import exact_duplicates
from mailspark.llm.language import UNKNOWN, language_column, language_model
from mailspark.llm.packing import pack
from mailspark.llm.secret_scan import mask_secrets
from mailspark.llm.simhash import near_duplicates
from mailspark.sources.scratch import written

LAST = (1 << 63) - 1


def _order() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))


def _text_key() -> Column:
    return hex_sha256(F.coalesce(F.col("text"), F.lit("")))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", _text_key().alias("text_key"))


def _kept(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose (doc_id, text_key) is kept; one of rows that repeat both."""
    wanted = kept.select(_order().alias("ord"), F.col("text_key").alias("key"))
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"),
        _order().alias("ord"),
        _text_key().alias("key"),
    )
    same = Window.partitionBy("ord", "key").orderBy("key")
    return (
        rows.join(wanted, ["ord", "key"], "left_semi")
        .withColumn("place", F.row_number().over(same))
        .where("place = 1")
        .select("doc.*")
    )


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter, in one language or several; ``lang`` is the language found.

    A document that is ``und`` goes.  If no label teaches anything, no language can be told:
    then all documents with a letter stay, with the label they have.
    """
    model = language_model(docs)
    if not model.langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    # Else the filter would be moved below the projection and each text be judged twice.
    judge = language_column(model).asNondeterministic()
    judged = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"),
        judge(F.col("text"))["lang_pred"].alias("found"),
    )
    names = {c: F.col("found") if c == "lang" else F.col(f"doc.`{c}`") for c in docs.columns}
    return judged.where(F.col("found") != UNKNOWN).select(*(v.alias(c) for c, v in names.items()))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, that with the smallest id."""
    found = exact_duplicates(_keyed(docs), carry=("text_key",))
    return _kept(docs, found.where("kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id."""
    found = near_duplicates(_keyed(docs), carry=("text_key",))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key"))
    return _kept(docs, found.groupBy("component").agg(first.alias("first")).select("first.*"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; live-looking credentials are masked, copied examples stay."""
    return mask_secrets(docs, length_column="n_chars")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their ids, in sequences of several lengths."""
    pieces = pack(
        docs,
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN,
        find_special=True,
    )
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("language", language),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("secrets", secrets),
    ("packing", packing),
]

#: SQL can express neither the language model nor the fingerprints nor the tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
