"""Terms and TF-IDF against plain Python on a small fixture."""

import math
import re
import time
from collections import Counter

import pytest
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from mailspark.config import CHAR_3_5, ENGLISH_STOP_WORDS, WORD_1_2, FeatureConfig
from mailspark.functions.terms import add_terms, char_ngrams, count_terms
from mailspark.operators.features import (
    idf_extremes,
    matrix_stats,
    prepared_terms,
    tfidf,
    vocabulary,
)
from mailspark.operators.vectors import with_index

TEXTS = {
    "a": "the cat sat on the mat cat",
    "b": "a cat and a dog",
    "c": "dog dog dog ok",
    "d": "",
    "e": "mat cat dog",
    "f": "a 😀 b😀cd 😀😀😀 é",
}


def python_terms(clean, config):
    if config.analyzer == "char_wb":
        out = []
        for word in clean.split():
            padded = f" {word} "
            for n in range(config.min_n, config.max_n + 1):
                if len(padded) <= n:
                    out.append(padded)
                    break
                out += [padded[i : i + n] for i in range(len(padded) - n + 1)]
        return out
    words = [w for w in re.findall(r"\w+", clean) if w not in config.stop_words]
    return [
        " ".join(words[i : i + n])
        for n in range(config.min_n, config.max_n + 1)
        for i in range(len(words) - n + 1)
    ]


@pytest.fixture(scope="module")
def mails(spark):
    return spark.createDataFrame(list(TEXTS.items()), "id string, text string")


@pytest.mark.parametrize(
    "config", [WORD_1_2, CHAR_3_5, CHAR_3_5.with_changes(min_n=1), CHAR_3_5.with_changes(min_n=5, max_n=6),
     WORD_1_2.with_changes(max_n=3, stop_words=())]
)
def test_terms_and_counts(mails, config):
    docs = add_terms(mails.withColumnRenamed("text", "clean"), config)
    for row in docs.collect():
        assert Counter(row["terms"]) == Counter(python_terms(TEXTS[row["id"]], config))
    for row in count_terms(docs).collect():
        counted = {t["token"]: t["tf"] for t in row["terms"]}
        assert counted == Counter(python_terms(TEXTS[row["id"]], config))
        assert len(counted) == len(row["terms"])


def test_weights(mails):
    config = WORD_1_2.with_changes(stop_words=(), max_df=0.7)
    docs = prepared_terms(mails, config)
    vocab = vocabulary(docs, config)
    n = len(TEXTS)
    df = Counter(t for text in TEXTS.values() for t in set(python_terms(text, config)))
    kept = {t: d for t, d in df.items() if 2 <= d <= 0.7 * n}
    idf = {t: math.log((1 + n) / (1 + d)) + 1 for t, d in kept.items()}
    assert {r["token"]: r["df"] for r in vocab.collect()} == kept
    expected = {}
    for name, text in TEXTS.items():
        tf = {t: c for t, c in Counter(python_terms(text, config)).items() if t in idf}
        w = {t: (1 + math.log(c)) * idf[t] for t, c in tf.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        expected.update({(name, t): x / norm for t, x in w.items()})
    found = {(r["id"], r["token"]): r["weight"] for r in tfidf(docs, vocab, config).collect()}
    assert found == pytest.approx(expected)
    stats = matrix_stats(docs, vocab).first()
    assert (stats["docs"], stats["vocabulary"], stats["nnz"]) == (n, len(kept), len(expected))
    assert stats["density"] == pytest.approx(len(expected) / (n * len(kept)))
    lowest = idf_extremes(vocab, 1).where("end = 'lowest'").first()
    assert lowest["token"] == min(idf, key=lambda t: (idf[t], t))


def test_index_is_dense(spark):
    vocab = spark.range(5000).select(F.col("id").cast("string").alias("token"))
    indices = sorted(r["index"] for r in with_index(vocab).collect())
    assert indices == list(range(5000))


def test_stop_words_are_sparks(spark):
    assert set(ENGLISH_STOP_WORDS) == set(StopWordsRemover.loadDefaultStopWords("english"))


def test_bad_settings():
    with pytest.raises(ValueError):
        FeatureConfig(analyzer="sentence")
    with pytest.raises(ValueError):
        FeatureConfig(min_n=3, max_n=2)


def test_long_words_have_the_same_ngrams(spark):
    words = ["a" * 10, "ab" * 40, "é日😀x" * 30, "y" * 63, "y" * 64, "z"]
    frame = spark.createDataFrame([(w,) for w in words], "clean string")
    for row in frame.select("clean", char_ngrams(F.col("clean"), 3, 5).alias("grams")).collect():
        padded, expected = f" {row['clean']} ", []
        for n in range(3, 6):
            if n <= max(3, len(padded)):
                expected += [padded[i : i + n] for i in range(max(1, len(padded) - n + 1))]
        assert row["grams"] == expected


def test_ngrams_of_a_run_take_linear_time(spark):
    def seconds(size):
        frame = spark.range(8, numPartitions=1).select(F.expr(f"repeat('ab', {size // 2})").alias("c"))
        grams = frame.select(F.size(char_ngrams(F.concat("c", F.lit("x")), 3, 5)).alias("n"))
        started = time.perf_counter()
        grams.agg(F.sum("n")).collect()
        return time.perf_counter() - started

    seconds(20_000)
    assert min(seconds(80_000) for _ in range(2)) < 3 * max(0.3, min(seconds(40_000) for _ in range(2)))
