"""Split, folds and dedup against plain sorting."""

import hashlib
import math

from pyspark.sql import functions as F

from mailspark.operators.dedup import drop_repeated_texts
from mailspark.operators.split import assign_parts, label_counts, split_counts


def mails_of(spark, ham, spam):
    ids = spark.range(ham + spam)
    return ids.select(
        F.sha1(F.col("id").cast("string").cast("binary")).alias("id"),
        F.when(F.col("id") < ham, 0).otherwise(1).alias("label"),
        F.concat(F.lit("t"), F.col("id") % 7).alias("text"),
        F.concat(F.lit("p/"), "id").alias("path"),
    )


def test_parts_are_stretches_of_the_seeded_order(spark):
    for ham, spam in ((40, 11), (333, 5), (7, 7), (600, 1)):
        rows = assign_parts(mails_of(spark, ham, spam)).collect()
        n = ham + spam
        test = math.ceil(n * 0.2)
        assert len(rows) == n and sum(r["split"] == "test" for r in rows) == test
        for label in (0, 1):
            of_label = sorted(
                (r for r in rows if r["label"] == label),
                key=lambda r: hashlib.md5(f"42:{r['id']}".encode()).hexdigest(),
            )
            parts = [(0 if r["split"] == "test" else 1, r["fold"] or 0) for r in of_label]
            assert parts == sorted(parts)
            share = sum(r["split"] == "test" for r in of_label)
            assert abs(share - len(of_label) * test / n) < 1
        folds = [sum(r["fold"] == f for r in rows) for f in range(3)]
        assert max(folds) - min(folds) <= 1
        for label in (0, 1):
            sizes = [sum(r["fold"] == f and r["label"] == label for r in rows) for f in range(3)]
            assert max(sizes) - min(sizes) <= 1


def test_split_does_not_depend_on_the_layout(spark):
    mails = mails_of(spark, 90, 30)
    a = {r["id"]: (r["split"], r["fold"]) for r in assign_parts(mails).collect()}
    b = {r["id"]: (r["split"], r["fold"]) for r in assign_parts(mails.repartition(5, "path")).collect()}
    assert a == b


def test_dedup_keeps_the_first_ham(spark):
    rows = [
        ("1", 1, "same", "a"), ("2", 0, "same", "z"), ("3", 0, "same", "b"),
        ("4", 1, "other", "c"), ("5", 0, "Same", "d"),
    ]
    mails = spark.createDataFrame(rows, "id string, label int, text string, path string")
    once = drop_repeated_texts(mails)
    assert {r["id"] for r in once.collect()} == {"3", "4", "5"}
    assert drop_repeated_texts(once).count() == 3


def test_counts(spark):
    mails = mails_of(spark, 8, 4).withColumn(
        "label_name", F.when(F.col("label") == 1, "spam").otherwise("ham")
    )
    assert {r["label"]: r["raw_file_count"] for r in label_counts(mails).collect()} == {
        "ham": 8, "spam": 4, "total": 12,
    }
    sums = split_counts(assign_parts(mails)).agg(F.sum("rows"), F.sum("ham")).first()
    assert tuple(sums) == (12, 8)
