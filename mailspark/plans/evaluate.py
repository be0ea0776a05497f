"""Evaluate a model on test mails and save the reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailspark.operators.errors import error_analysis
from mailspark.operators.metrics import classification_report, metric_row
from mailspark.operators.scoring import THRESHOLDS, near_threshold, threshold_predictions
from mailspark.plans.model import MailModel
from mailspark.sources.mails import label_name
from mailspark.sources.reports import save_table
from mailspark.sources.scratch import written


def evaluate(model: MailModel, test: DataFrame, out: str | None = None) -> dict[str, DataFrame]:
    """Metric row, classification report and error analysis; with ``out``, saved as csv."""
    scored = written(model.score(test), "scored")
    reports = {
        "eval_metrics": metric_row(scored, model.name),
        "classification_report": classification_report(scored),
        "misclassified_examples": error_analysis(scored),
    }
    if out is not None:
        for name, table in reports.items():
            save_table(table, f"{out}/{name}", "csv")
    return reports


def default_threshold(model: MailModel) -> float:
    """Where a model's kind of score divides the classes."""
    return THRESHOLDS[model.score_type]


def predict(
    model: MailModel, mails: DataFrame, threshold: float | str | None = None
) -> DataFrame:
    """Mails with label name, score and a flag for scores close to the threshold.

    Without a threshold the model's own decision holds; ``"default"`` stands for the
    threshold of the model's kind of score.
    """
    if threshold == "default":
        threshold = default_threshold(model)
    scored = threshold_predictions(model.score(mails), threshold)
    return scored.withColumn("predicted_label", label_name(F.col("prediction"))).withColumn(
        "low_confidence", near_threshold(threshold)
    )
