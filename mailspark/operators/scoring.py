"""Threshold decisions over scored mails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailspark.config import DECISION_MARGIN, HAM, SPAM

# Default thresholds by kind of score.
THRESHOLDS = {"probability": 0.5, "decision": 0.0}


def threshold_predictions(scored: DataFrame, threshold: float | None) -> DataFrame:
    """Spam where the score reaches the threshold; the model's own label without one."""
    if threshold is None:
        return scored
    reached = F.when(F.col("score") >= threshold, SPAM).otherwise(HAM)
    own = F.col("prediction") if "prediction" in scored.columns else F.lit(None).cast("int")
    return scored.withColumn(
        "prediction", F.when(F.col("score").isNull(), own).otherwise(reached)
    )


def near_threshold(threshold: float | None, margin: float = DECISION_MARGIN) -> Column:
    """Whether the score is within the margin of the threshold."""
    if threshold is None:
        return F.lit(False)
    return F.coalesce(F.abs(F.col("score") - F.lit(threshold)) < margin, F.lit(False))
