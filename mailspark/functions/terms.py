"""Terms of a cleaned mail, as array columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailspark.config import FeatureConfig
from mailspark.functions.clean import WORD, clean_text


def word_tokens(clean: Column) -> Column:
    return F.regexp_extract_all(clean, F.lit(f"[{WORD}]+"), F.lit(0))


def without_stop_words(tokens: Column, stop_words: tuple[str, ...]) -> Column:
    if not stop_words:
        return tokens
    return F.filter(tokens, lambda t: ~t.isin(*stop_words))


def word_ngrams(tokens: Column, n: int) -> Column:
    """Space-joined runs of ``n`` neighbouring tokens."""
    grams = tokens
    for shift in range(1, n):
        tail = F.slice(tokens, shift + 1, F.greatest(F.size(tokens) - shift, F.lit(0)))
        grams = F.zip_with(
            F.slice(grams, 1, F.greatest(F.size(tokens) - shift, F.lit(0))),
            tail,
            lambda a, b: F.concat(a, F.lit(" "), b),
        )
    return grams


def blank_words(clean: Column) -> Column:
    """What stands between blanks."""
    return F.filter(F.split(clean, " "), lambda w: F.length(w) > 0)


def ngrams_of_word(word: str, min_n: int, max_n: int) -> list[str]:
    """What ``char_ngrams`` takes from one word."""
    padded = f" {word} "
    size = len(padded)
    return [
        padded[at : at + n]
        for n in range(min_n, max(min_n, min(max_n, size)) + 1)
        for at in range(max(size - n + 1, 1))
    ]


#: Characters from which a word is cut into single characters before its n-grams.
LONG_WORD = 64


def char_ngrams(clean: Column, min_n: int, max_n: int) -> Column:
    """Character n-grams inside each word, the word padded by a blank on both sides.

    A padded word no longer than ``n`` is taken whole, once, and larger ``n`` are
    skipped for it.
    """
    words = blank_words(clean)

    def cut(word: Column, gram: Callable[[Column, Column], Column]) -> Column:
        size = F.length(word) + 2
        sizes = F.sequence(F.lit(min_n), F.greatest(F.lit(min_n), F.least(F.lit(max_n), size)))
        return F.flatten(
            F.transform(
                sizes,
                lambda n: F.transform(
                    F.sequence(F.lit(1), F.greatest(size - n + 1, F.lit(1))),
                    lambda at: gram(at, n),
                ),
            )
        )

    def padded(word: Column) -> Column:
        return F.concat(F.lit(" "), word, F.lit(" "))

    def of_long(word: Column) -> Column:
        # A substring is looked for from the start of the word each time; slices of the
        # word's characters aren't.  The array is bound once, to a lambda variable.
        characters = F.array(F.split(padded(word), ""))
        return F.flatten(
            F.transform(
                characters,
                lambda c: cut(word, lambda at, n: F.array_join(F.slice(c, at, n), "")),
            )
        )

    def grams_of(word: Column) -> Column:
        short = cut(word, lambda at, n: F.substring(padded(word), at, n))
        return F.when(F.length(word) < LONG_WORD, short).otherwise(of_long(word))

    return F.flatten(F.transform(words, grams_of))


def add_terms(df: DataFrame, config: FeatureConfig, clean: str = "clean") -> DataFrame:
    """Add ``terms``: every term of the mail with its repeats."""
    if config.analyzer == "char_wb":
        return df.withColumn("terms", char_ngrams(F.col(clean), config.min_n, config.max_n))
    df = df.withColumn("_tokens", word_tokens(F.col(clean)))
    df = df.withColumn("_tokens", without_stop_words(F.col("_tokens"), config.stop_words))
    grams = [word_ngrams(F.col("_tokens"), n) for n in range(config.min_n, config.max_n + 1)]
    return df.withColumn("terms", F.concat(*grams)).drop("_tokens")


def term_documents(mails: DataFrame, config: FeatureConfig) -> DataFrame:
    """Mails with ``text`` replaced by ``terms``."""
    return add_terms(clean_text(mails), config).drop("text", "clean")


def word_documents(mails: DataFrame) -> DataFrame:
    """Mails with ``text`` replaced by ``terms``, the words that ``char_ngrams`` cuts."""
    return clean_text(mails).withColumn("terms", blank_words(F.col("clean"))).drop("text", "clean")


def count_terms(df: DataFrame) -> DataFrame:
    """Replace ``terms`` by its counts, an array of (token, tf).

    The sorted terms are cut where one run of equal terms ends, so the counting
    stays inside the row: no shuffle, and no more memory than one mail needs.
    """
    ordered = df.withColumn("terms", F.sort_array("terms")).withColumn("_n", F.size("terms"))
    run_ends = F.filter(
        F.sequence(F.lit(1), F.greatest("_n", F.lit(1))),
        lambda i: (i == F.col("_n"))
        | (F.get("terms", i) != F.get("terms", i - 1)),
    )
    ordered = ordered.withColumn("_ends", F.when(F.col("_n") > 0, run_ends).otherwise(F.array()))
    starts = F.slice(F.concat(F.array(F.lit(0)), "_ends"), 1, F.size("_ends"))
    counted = F.zip_with(
        "_ends",
        starts,
        lambda end, start: F.struct(
            F.get("terms", end - 1).alias("token"), (end - start).alias("tf")
        ),
    )
    return ordered.withColumn("terms", counted).drop("_n", "_ends")
