"""Misclassified mails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailspark.config import PREVIEW_CHARS
from mailspark.functions.clean import SPACE
from mailspark.operators.metrics import DIGITS
from mailspark.sources.mails import label_name

def word_count(text: Column) -> Column:
    """White-space separated words."""
    return F.size(F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != ""))


def misclassified(scored: DataFrame) -> DataFrame:
    """Wrongly predicted mails, unsorted, with unrounded score and confidence."""
    score = F.col("score") if "score" in scored.columns else F.lit(None).cast("double")
    squeezed = F.regexp_replace("text", f"[{SPACE}]+", " ")
    wrong = scored.where(F.col("label") != F.col("prediction"))
    return wrong.select(
        *[c for c in ("id", "path") if c in scored.columns],
        label_name(F.col("label")).alias("true_name"),
        label_name(F.col("prediction")).alias("predicted_name"),
        score.alias("score"),
        F.abs(score).alias("confidence"),
        F.length("text").alias("length_chars"),
        word_count(F.col("text")).alias("length_words"),
        F.substring(squeezed, 1, PREVIEW_CHARS).alias("text_preview"),
    )


def error_analysis(scored: DataFrame, k: int | None = None) -> DataFrame:
    """Wrongly predicted mails, the most confident and longest first; ``k`` keeps the top."""
    errors = misclassified(scored)
    ties = [c for c in ("id", "path") if c in errors.columns][:1]
    errors = errors.orderBy(F.desc("confidence"), F.desc("length_words"), *ties)
    if k is not None:
        errors = errors.limit(k)
    return errors.withColumn("score", F.round("score", DIGITS)).withColumn(
        "confidence", F.round("confidence", DIGITS)
    )
