"""Stop words: the English list, a list file, or both."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from mailspark.config import ENGLISH_STOP_WORDS
from mailspark.functions.clean import strip_space

BYTE_ORDER_MARK = "﻿"


def read_stop_words(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Words of a list file, one a line, in order of the file's lines.

    Blank lines and lines that begin with # are left out, a byte-order mark is ignored,
    and a file that isn't there holds no words.
    """
    try:
        lines = spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return ()
    word = strip_space(F.replace("value", F.lit(BYTE_ORDER_MARK), F.lit("")))
    kept = lines.select(word.alias("word")).where("word <> '' AND NOT startswith(word, '#')")
    return tuple(r["word"] for r in kept.collect())  # a list that people keep


def stop_words(
    spark: SparkSession, path: str | None = None, english: bool = True, listed: bool = True
) -> tuple[str, ...]:
    """The union of the English list and the list file, each by its switch, sorted."""
    found = set(ENGLISH_STOP_WORDS) if english else set()
    if listed and path is not None:
        found.update(read_stop_words(spark, path))
    return tuple(sorted(found))
