"""The registered queries of this package, each a thin digest of its operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailspark.llm.common import hex_sha256, table
from mailspark.llm.exact_dedup import exact_duplicates
from mailspark.llm.html_text import extract
from mailspark.llm.language import held_out, language_model, predict
from mailspark.llm.lexical_search import rank_documents
from mailspark.llm.mil_quality import THRESHOLD, quality_model, score_documents
from mailspark.llm.mil_quality import held_out as quality_held_out
from mailspark.llm.packing import pack
from mailspark.llm.pieces import ID_BYTES, MARK, encode_and_decode
from mailspark.llm.repetition import judge, measure
from mailspark.llm.secret_scan import KINDS, find_secrets
from mailspark.llm.simhash import near_duplicates
from mailspark.llm.spelling import spelling_variants
from mailspark.llm.substring_dedup import repeated_passages
from mailspark.llm.warc import round_trip

BYTE_VOCABULARY = "byte_bpe_50k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"


def exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_duplicates(table(spark, folder, "documents", "doc_id", "text"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every text, and whether they decode to the text (space marks as spaces)."""
    model = public_tokenizers.path(PIECE_VOCABULARY)
    found = encode_and_decode(table(spark, folder, "documents", "doc_id", "text"), model)
    text = F.translate(F.coalesce("text", F.lit("")), MARK, " ")
    return found.select(
        "doc_id",
        F.expr(f"octet_length(ids) div {ID_BYTES}").cast("long").alias("n_ids"),
        F.crc32("ids").alias("ids_crc32"),
        hex_sha256(F.col("decoded")).alias("decoded_sha256"),
        (F.col("decoded") == text).alias("round_trip"),
    )


def repetition(spark: SparkSession, folder: str) -> DataFrame:
    return judge(measure(table(spark, folder, "documents", "doc_id", "text"))).drop(
        "spans", "n_repeats", "longest_repeat"
    )


def secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = find_secrets(table(spark, folder, "documents", "doc_id", "text", "source"))
    names = F.array(*(F.lit(k) for k in KINDS))

    def digest(spans):
        return F.array_join(
            F.transform(
                spans,
                lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["stop"]),
            ),
            ",",
        )

    def count(condition):
        return F.size(F.filter("spans", condition)).cast("long")

    def of_kind(kind: int):
        return count(lambda s: s["kind"] == kind)

    base = F.filter("spans", lambda s: s["kind"] < 3)
    return found.select(
        "doc_id",
        *(of_kind(i).alias(f"n_{k}") for i, k in enumerate(KINDS)),
        F.sha2(digest(base).cast("binary"), 256).alias("base_sha256"),
        digest("spans").alias("spans"),
        count(lambda s: s["live"]).alias("n_live"),
    )


def simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(table(spark, folder, "documents", "doc_id", "text"))
    return found.select("doc_id", "fingerprint", "component_id")


def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = repeated_passages(table(spark, folder, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def warc(spark: SparkSession, folder: str) -> DataFrame:
    found = round_trip(spark, table(spark, folder, "pages", "page_id", "url", "html"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def html_text(spark: SparkSession, folder: str) -> DataFrame:
    found = extract(table(spark, folder, "pages", "page_id", "url", "html"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text", "lang")
    found = predict(docs, language_model(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = pack(
        table(spark, folder, "documents", "doc_id", "text"),
        public_tokenizers.path(BYTE_VOCABULARY),
        public_tokenizers.PATTERN,
        find_special=True,
    )
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "tier",
        "step_group",
    )


def lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return rank_documents(
        table(spark, folder, "documents", "doc_id", "text"),
        table(spark, folder, "benchmark", "item_id", "text"),
    )


def quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    net = quality_model(docs, table(spark, folder, "labels", "doc_id", "quality"))
    return score_documents(docs, net).select(
        "doc_id",
        quality_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(table(spark, folder, "documents", "doc_id", "text"))


QUERIES = {
    "op6_pieces": pieces,
    "op1_html": html_text,
    "op2_language": language,
    "op3_repetition": repetition,
    "op4_secrets": secrets,
    "op5_exact_dedup": exact_dedup,
    "op7_substring_dedup": substring_dedup,
    "op8_warc": warc,
    "op9_simhash": simhash,
    "op10_packing": packing,
    "op11_lexical_search": lexical_search,
    "op12_quality": quality,
    "op13_spelling": spelling,
}
