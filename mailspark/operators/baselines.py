"""Predictions that need no features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailspark.config import HAM, KEYWORDS, SPAM


def majority_predictions(train: DataFrame, mails: DataFrame) -> DataFrame:
    """The commonest training label, the smaller one on ties, for every mail."""
    commonest = (
        train.groupBy("label")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "label")
        .limit(1)
        .select("label")
        .scalar()
    )
    return mails.withColumn("prediction", commonest.cast("int"))


def has_keyword(text: Column, keywords: tuple[str, ...] = KEYWORDS) -> Column:
    """Whether the lower-cased text holds any keyword, inside words too."""
    found = F.lit(False)
    for word in keywords:
        found = found | F.contains(text, F.lit(word.lower()))
    return found


def keyword_predictions(mails: DataFrame, keywords: tuple[str, ...] = KEYWORDS) -> DataFrame:
    lowered = mails.withColumn("_lower", F.lower("text"))
    hit = has_keyword(F.col("_lower"), keywords)
    return lowered.withColumn("prediction", F.when(hit, SPAM).otherwise(HAM)).drop("_lower")
