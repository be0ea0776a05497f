"""Metrics against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from mailspark.operators.errors import error_analysis
from mailspark.operators.metrics import (
    classification_report,
    confusion_matrix,
    metric_row,
    metric_rows,
    roc_auc,
)
from mailspark.operators.scoring import near_threshold, threshold_predictions

SCHEMA = "model string, label int, prediction int, score double"


def pair_auc(rows):
    pos = [s for _, y, _, s in rows if y == 1]
    neg = [s for _, y, _, s in rows if y == 0]
    if not pos or not neg:
        return None
    won = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    return won / (len(pos) * len(neg))


def test_auc_with_ties_skew_and_groups(spark):
    rng = random.Random(7)
    rows = [("tied", rng.randint(0, 1), 0, rng.randint(0, 9) / 9) for _ in range(200)]
    rows += [("hot", rng.randint(0, 1), 0, 0.5 if rng.random() < 0.5 else rng.random()) for _ in range(300)]
    rows += [("one class", 0, 0, rng.random()) for _ in range(5)]
    rows += [("negative", rng.randint(0, 1), 0, rng.gauss(0, 3)) for _ in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    for buckets in (2, 256):
        found = {r["model"]: r["roc_auc"] for r in roc_auc(df, ["model"], buckets).collect()}
        for name in ("tied", "hot", "negative"):
            assert found[name] == pytest.approx(pair_auc([r for r in rows if r[0] == name]))
        assert found["one class"] is None
    flipped = roc_auc(df.where("model = 'negative'").withColumn("score", -F.col("score")))
    own = roc_auc(df.where("model = 'negative'"))
    assert flipped.first()[0] == pytest.approx(1 - own.first()[0])


def test_rates_by_hand(spark):
    rows = [("m", 0, 0, 0.1)] * 5 + [("m", 0, 1, 0.9)] + [("m", 1, 0, 0.2)] * 2 + [("m", 1, 1, 0.8)] * 2
    row = metric_rows(spark.createDataFrame(rows, SCHEMA)).first()
    assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (5, 1, 2, 2)
    assert row["tn"] + row["fp"] + row["fn"] + row["tp"] == len(rows)
    expected = {
        "precision_spam": 2 / 3, "recall_spam": 0.5, "f1_spam": 4 / 7, "f1_ham": 10 / 13,
        "macro_f1": (4 / 7 + 10 / 13) / 2, "weighted_f1": (4 * 4 / 7 + 6 * 10 / 13) / 10,
        "balanced_accuracy": (5 / 6 + 0.5) / 2, "npv": 5 / 7, "accuracy": 0.7,
        "false_positive_rate": 1 / 6, "false_negative_rate": 0.5, "specificity": 5 / 6,
    }
    assert {k: row[k] for k in expected} == pytest.approx(expected)


def test_zero_division_and_unseen_classes(spark):
    rows = [("m", 0, 0, None)] * 3
    df = spark.createDataFrame(rows, SCHEMA)
    row = metric_row(df, "m").first()
    assert (row["precision_spam"], row["f1_spam"], row["npv"], row["roc_auc"]) == (0, 0, 1, None)
    assert (row["macro_f1"], row["balanced_accuracy"], row["accuracy"]) == (1, 1, 1)
    report = {r["class"]: r for r in classification_report(df).collect()}
    assert report["macro avg"]["f1_score"] == 0.5
    assert report["accuracy"]["precision"] is None and report["accuracy"]["support"] == 3
    assert [tuple(r) for r in confusion_matrix(df).collect()] == [("true_ham", 3, 0), ("true_spam", 0, 0)]


def test_errors_are_sorted_before_rounding(spark):
    rows = [
        ("1", "p1", 1, 0, -2.00000001, "a b"), ("2", "p2", 0, 1, 2.00000002, "a"),
        ("3", "p3", 0, 0, 9.0, "x"), ("4", "p4", 1, 0, 0.5, " a\n\tb " + "w " * 200),
    ]
    df = spark.createDataFrame(
        rows, "id string, path string, label int, prediction int, score double, text string"
    )
    found = error_analysis(df).collect()
    assert [r["id"] for r in found] == ["2", "1", "4"]
    assert (found[0]["true_name"], found[0]["predicted_name"]) == ("ham", "spam")
    assert (found[2]["length_words"], len(found[2]["text_preview"])) == (202, 220)
    assert found[2]["text_preview"].startswith(" a b w")
    assert [r["id"] for r in error_analysis(df, 1).collect()] == ["2"]


def test_thresholds(spark):
    df = spark.createDataFrame([("m", 0, 0, 0.5), ("m", 0, 1, 0.49), ("m", 0, 1, None)], SCHEMA)
    assert [r["prediction"] for r in threshold_predictions(df, 0.5).collect()] == [1, 0, 1]
    assert [r["prediction"] for r in threshold_predictions(df, None).collect()] == [0, 1, 1]
    flags = [r[0] for r in df.select(near_threshold(0.61)).collect()]
    assert flags == [True, False, False]
