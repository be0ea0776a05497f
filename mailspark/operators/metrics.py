"""Binary-classification metrics over ``label, prediction[, score]`` rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailspark.config import HAM, METRIC_NAMES, SPAM

DIGITS = 6
SCORE_BUCKETS = 256


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom``, 0 where the bottom is 0."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def f1_score(hits: str, false_hits: str, misses: str) -> Column:
    hit = F.col(hits)
    return ratio(2 * hit, 2 * hit + F.col(false_hits) + F.col(misses))


def confusion(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``tn, fp, fn, tp``, per group if ``by`` is given."""

    def count(label: int, prediction: int, name: str) -> Column:
        return F.count_if(
            (F.col("label") == label) & (F.col("prediction") == prediction)
        ).alias(name)

    return scored.groupBy(*by).agg(
        count(HAM, HAM, "tn"), count(HAM, SPAM, "fp"), count(SPAM, HAM, "fn"), count(SPAM, SPAM, "tp")
    )


def confusion_matrix(scored: DataFrame) -> DataFrame:
    """The 2x2 view: one row per true class."""
    return confusion(scored).select(
        F.inline(
            F.array(
                F.struct(
                    F.lit("true_ham").alias("actual"),
                    F.col("tn").alias("pred_ham"),
                    F.col("fp").alias("pred_spam"),
                ),
                F.struct(
                    F.lit("true_spam").alias("actual"),
                    F.col("fn").alias("pred_ham"),
                    F.col("tp").alias("pred_spam"),
                ),
            )
        )
    )


def _mean_over_seen(ham: Column, spam: Column, ham_seen: Column, spam_seen: Column) -> Column:
    seen = ham_seen.cast("int") + spam_seen.cast("int")
    return ratio(
        F.when(ham_seen, ham).otherwise(0.0) + F.when(spam_seen, spam).otherwise(0.0), seen
    )


def add_rates(counts: DataFrame) -> DataFrame:
    """All metrics that follow from the four counts, unrounded."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    support_ham, support_spam = tn + fp, fn + tp
    n = support_ham + support_spam
    f1_ham, f1_spam = f1_score("tn", "fn", "fp"), f1_score("tp", "fp", "fn")
    # Averages are over the classes seen in truth or prediction; balanced
    # accuracy is over those seen in truth.
    macro_f1 = _mean_over_seen(f1_ham, f1_spam, (support_ham + fn) > 0, (support_spam + fp) > 0)
    recall_ham, recall_spam = ratio(tn, support_ham), ratio(tp, support_spam)
    return counts.select(
        "*",
        ratio(tn, tn + fn).alias("precision_ham"),
        recall_ham.alias("recall_ham"),
        f1_ham.alias("f1_ham"),
        support_ham.alias("support_ham"),
        ratio(tp, tp + fp).alias("precision_spam"),
        recall_spam.alias("recall_spam"),
        f1_spam.alias("f1_spam"),
        support_spam.alias("support_spam"),
        macro_f1.alias("macro_f1"),
        ratio(support_ham * f1_ham + support_spam * f1_spam, n).alias("weighted_f1"),
        _mean_over_seen(recall_ham, recall_spam, support_ham > 0, support_spam > 0).alias(
            "balanced_accuracy"
        ),
        recall_ham.alias("specificity"),
        ratio(tn, tn + fn).alias("npv"),
        ratio(fp, support_ham).alias("false_positive_rate"),
        ratio(fn, support_spam).alias("false_negative_rate"),
        ratio(tn + tp, n).alias("accuracy"),
    )


def roc_auc(scored: DataFrame, by: Sequence[str] = (), buckets: int = SCORE_BUCKETS) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; null without both classes.

    Equal scores are first merged into one row.  Those rows are cut at score
    quantiles, summed up inside each bucket, and the few bucket sums are chained,
    so no running sum ever goes over all scores in one task.  Where the cuts fall
    affects the balance only, not the result.
    """
    groups = list(by) or [F.lit(0).alias("_all")]
    names = list(by) or ["_all"]
    merged = (
        scored.where(F.col("score").isNotNull())
        .select(*groups, "label", "score")
        .groupBy(*names, "score")
        .agg(
            F.count_if(F.col("label") == SPAM).alias("pos"),
            F.count_if(F.col("label") == HAM).alias("neg"),
        )
    )
    marks = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    cuts = merged.groupBy(*names).agg(F.percentile_approx("score", marks).alias("cuts"))
    bucket = F.size(F.filter("cuts", lambda c: c < F.col("score")))
    if by:
        placed = merged.join(F.broadcast(cuts), names)  # one row per group
    else:
        placed = merged.withColumn("cuts", cuts.select("cuts").scalar())
    placed = placed.select(*names, "score", "pos", "neg", bucket.alias("bucket"))
    lower = (
        Window.partitionBy(*names, "bucket")
        .orderBy("score")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    below = F.coalesce(F.sum("neg").over(lower), F.lit(0)) + F.col("neg") / 2
    inside = (
        placed.withColumn("won", F.col("pos") * below)
        .groupBy(*names, "bucket")
        .agg(F.sum("won").alias("won"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    earlier = (
        Window.partitionBy(*names).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum("neg").over(earlier), F.lit(0))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return (
        inside.withColumn("won", F.col("won") + F.col("pos") * before)
        .groupBy(*names)
        .agg(F.try_divide(F.sum("won"), pairs).alias("roc_auc"))
        .select(*by, "roc_auc")
    )


def metric_rows(scored: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """One row of all metrics per group, unrounded; ``roc_auc`` is null without scores."""
    rates = add_rates(confusion(scored, by))
    if "score" in scored.columns:
        area = roc_auc(scored, by)
        # One row per group on both sides.
        rates = rates.join(F.broadcast(area), list(by), "left")
    else:
        rates = rates.withColumn("roc_auc", F.lit(None).cast("double"))
    return rates.select(*by, *METRIC_NAMES)


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column."""
    doubles = {f.name for f in df.schema.fields if f.dataType.typeName() == "double"}
    return df.select(
        *[F.round(c, digits).alias(c) if c in doubles else F.col(c) for c in df.columns]
    )


def metric_row(scored: DataFrame, model: str) -> DataFrame:
    """The rounded metric row of one model's scored mails."""
    return rounded(metric_rows(scored.withColumn("model", F.lit(model))))


def classification_report(scored: DataFrame) -> DataFrame:
    """Ham, spam, macro and weighted averages, and accuracy (held in ``f1_score``).

    Both classes always count in the macro average, seen or not.
    """
    rates = add_rates(confusion(scored))
    ham, spam = F.col("support_ham"), F.col("support_spam")
    n = ham + spam

    def row(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            F.round(precision, DIGITS).alias("precision"),
            F.round(recall, DIGITS).alias("recall"),
            F.round(f1, DIGITS).alias("f1_score"),
            support.alias("support"),
        )

    def plain(metric: str) -> Column:
        return (F.col(f"{metric}_ham") + F.col(f"{metric}_spam")) / 2

    def weighted(metric: str) -> Column:
        return ratio(ham * F.col(f"{metric}_ham") + spam * F.col(f"{metric}_spam"), n)

    none = F.lit(None).cast("double")
    names = ("precision", "recall", "f1")
    return rates.select(
        F.inline(
            F.array(
                row("ham", *[F.col(f"{m}_ham") for m in names], ham),
                row("spam", *[F.col(f"{m}_spam") for m in names], spam),
                row("macro avg", *[plain(m) for m in names], n),
                row("weighted avg", *[weighted(m) for m in names], n),
                row("accuracy", none, none, F.col("accuracy"), n),
            )
        )
    )
