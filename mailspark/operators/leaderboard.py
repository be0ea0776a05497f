"""Ranking of metric rows.  All tables here have one row per model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailspark.config import LEADERBOARD_HEAD, METRIC_NAMES, MODEL_LABELS
from mailspark.operators.metrics import rounded

BASELINES = ("majority", "keyword")


def leaderboard(rows: DataFrame) -> DataFrame:
    """Rounded rows by F1 on spam, then accuracy, then the given ``model_order``."""
    extras = [c for c in METRIC_NAMES if c not in LEADERBOARD_HEAD]
    return (
        rounded(rows)
        .orderBy(F.desc("f1_spam"), F.desc("accuracy"), "model_order")
        .select(*LEADERBOARD_HEAD, *extras)
    )


def best_model(rows: DataFrame) -> DataFrame:
    """The trained model with the highest unrounded F1 on spam; the first wins ties."""
    trained = rows.where(~F.col("model").isin(*BASELINES))
    return trained.orderBy(F.desc("f1_spam"), "model_order").limit(1)


def best_row(board: DataFrame) -> DataFrame:
    return board.orderBy(F.desc("f1_spam"), "model").limit(1)


def row_of(board: DataFrame, model: str | None) -> DataFrame:
    """The row of one model; no row when it is unknown or not given."""
    return board.where(F.col("model") == F.lit(model)).limit(1)


def display_name(model: Column) -> Column:
    name = model
    for key, label in MODEL_LABELS.items():
        name = F.when(model == key, label).otherwise(name)
    return name


def leaderboard_display(board: DataFrame) -> DataFrame:
    """Readable model names and percentages, by F1 on spam."""
    return (
        board.withColumn("model_label", display_name(F.col("model")))
        .withColumn("precision_pct", F.col("precision_spam") * 100)
        .withColumn("recall_pct", F.col("recall_spam") * 100)
        .withColumn("f1_pct", F.col("f1_spam") * 100)
        .withColumn("accuracy_pct", F.col("accuracy") * 100)
        .orderBy(F.desc("f1_spam"), "model")
    )


def leader_summary(board: DataFrame, primary: str = "svm") -> DataFrame:
    """Leader, runner-up, margin, and the leader's gap to nb, lr and the primary model."""
    ranked = leaderboard_display(board).withColumn(
        "place", F.row_number().over(Window.orderBy(F.desc("f1_spam"), "model"))
    )

    def at(place: int, column: str) -> Column:
        return F.max(F.when(F.col("place") == place, F.col(column)))

    def of(model: str) -> Column:
        return F.max(F.when(F.col("model") == model, F.col("f1_pct")))

    top = at(1, "f1_pct")
    return ranked.agg(
        at(1, "model_label").alias("leader"),
        top.alias("leader_f1_pct"),
        at(1, "accuracy_pct").alias("leader_accuracy_pct"),
        at(2, "model_label").alias("runner_up"),
        at(2, "f1_pct").alias("runner_up_f1_pct"),
        F.coalesce(top - at(2, "f1_pct"), F.lit(0.0)).alias("margin"),
        (top - of("nb")).alias("gap_to_nb"),
        (top - of("lr")).alias("gap_to_lr"),
        of(primary).alias("primary_f1_pct"),
        (top - of(primary)).alias("gap_to_primary"),
    )
