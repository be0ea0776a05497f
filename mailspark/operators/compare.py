"""Several models on the same mails."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailspark.operators.leaderboard import display_name
from mailspark.sources.mails import label_name


def model_comparison(
    scored: DataFrame,
    board: DataFrame,
    primary: str,
    primary_threshold: float | None = None,
) -> DataFrame:
    """One row per mail and model.

    ``scored`` has id, model, model_order, prediction, score, score_type and
    optionally ``label``, the expected class.  Only the primary model follows a
    custom threshold.
    """
    is_primary = F.col("model") == primary
    rows = scored.withColumn(
        "role", F.when(is_primary, "Primary demo").otherwise("Compare")
    ).withColumn("threshold_mode", F.lit("model default"))
    if primary_threshold is not None:
        custom = is_primary & F.col("score").isNotNull()
        reached = (F.col("score") >= primary_threshold).cast("int")
        rows = rows.withColumn(
            "prediction", F.when(custom, reached).otherwise(F.col("prediction"))
        ).withColumn(
            "threshold_mode",
            F.when(is_primary, "custom threshold").otherwise(F.col("threshold_mode")),
        )
    facts = board.select(
        "model", F.col("accuracy").alias("test_accuracy"), F.col("f1_spam").alias("test_f1_spam")
    )
    expected = []
    if "label" in scored.columns:
        expected = [(F.col("prediction") == F.col("label")).alias("match_expected")]
    return rows.join(F.broadcast(facts), "model", "left").select(  # one row per model
        "id",
        F.col("model_order").alias("order"),
        "role",
        display_name(F.col("model")).alias("model"),
        label_name(F.col("prediction")).alias("prediction"),
        "score",
        "score_type",
        "threshold_mode",
        "test_accuracy",
        "test_f1_spam",
        *expected,
    )


def vote_summary(comparison: DataFrame) -> DataFrame:
    """Votes per mail; matches only where the expected class is known."""
    matches = []
    if "match_expected" in comparison.columns:
        matches = [F.count_if("match_expected").alias("matches_expected")]
    return comparison.groupBy("id").agg(
        F.count("*").alias("models_compared"),
        F.count_if(F.col("prediction") == "spam").alias("spam_votes"),
        F.count_if(F.col("prediction") == "ham").alias("ham_votes"),
        *matches,
    )
