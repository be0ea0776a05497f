"""Stratified split and folds, previews, samples and corpus counts.

Mails of a label are put in a seeded order, that of ``md5("<seed>:<id>")``, and
every part is one stretch of that order.  A part is thus known from its last
digest alone.  Those few digests are found from a histogram of digest prefixes,
so no label is ever sorted or gathered as a whole, and assigning the parts is a
filter-like step on each mail.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailspark.config import FOLDS, HAM, SEED, SPAM, TEST_SHARE
from mailspark.functions.clean import clean_text

PREFIX_CHARS = 4


def order_key(seed: int = SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), "id").cast("binary"))


def part_sizes(counts: DataFrame, test_share: float = TEST_SHARE, folds: int = FOLDS) -> DataFrame:
    """Rows of each part per label, from ``label, n`` rows (one row per label).

    The train rows are shared among the labels in proportion, rounded by largest
    remainder.  Fold sizes deal the train rows, sorted by label, out in turn.
    """
    everything = Window.partitionBy()
    by_remainder = Window.orderBy(F.desc("remainder"), "label")
    before = Window.orderBy("label").rowsBetween(Window.unboundedPreceding, -1)
    sized = (
        counts.withColumn("total", F.sum("n").over(everything))
        .withColumn("train_total", F.col("total") - F.ceil(F.col("total") * F.lit(test_share)))
        .withColumn("_share", F.col("n").cast("decimal(19,0)") * F.col("train_total").cast("decimal(19,0)"))
        .withColumn("base", F.expr("_share div total"))
        .withColumn("remainder", F.expr("_share % total"))
        .withColumn("open", F.col("train_total") - F.sum("base").over(everything))
        .withColumn("rank", F.row_number().over(by_remainder))
        .withColumn("train", F.col("base") + F.when(F.col("rank") <= F.col("open"), 1).otherwise(0))
        .withColumn("start", F.coalesce(F.sum("train").over(before), F.lit(0)))
    )
    fold_rows = [
        F.expr(f"(start + train - {f} + {folds - 1}) div {folds} - (start - {f} + {folds - 1}) div {folds}")
        .cast("long")
        .alias(f"fold_{f}")
        for f in range(folds)
    ]
    return sized.select(
        "label", "n", (F.col("n") - F.col("train")).cast("long").alias("test"), *fold_rows
    )


def part_ends(
    mails: DataFrame, seed: int = SEED, test_share: float = TEST_SHARE, folds: int = FOLDS
) -> DataFrame:
    """One row per label: the last digest of the test part and of each fold but the last."""
    keyed = mails.select("label", order_key(seed).alias("key")).withColumn(
        "prefix", F.substring("key", 1, PREFIX_CHARS)
    )
    histogram = keyed.groupBy("label", "prefix").agg(F.count("*").alias("rows"))
    running = Window.partitionBy("label").orderBy("prefix")
    histogram = histogram.withColumn("upto", F.sum("rows").over(running))
    sizes = part_sizes(
        histogram.groupBy("label").agg(F.sum("rows").alias("n")), test_share, folds
    )
    ends, reached = [], F.col("test")
    ends.append(F.struct(F.lit("test").alias("part"), reached.alias("rank")))
    for fold in range(folds - 1):
        reached = reached + F.col(f"fold_{fold}")
        ends.append(F.struct(F.lit(f"fold_{fold}").alias("part"), reached.alias("rank")))
    wanted = sizes.select("label", F.inline(F.array(*ends)))
    crossing = (F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("rows") < F.col("rank"))
    spots = (
        histogram.join(F.broadcast(wanted), "label")
        .where(crossing)
        .select(
            "label", "prefix", "part", (F.col("rank") - F.col("upto") + F.col("rows")).alias("nth")
        )
    )
    # At most (labels x parts) spots, so this broadcast is bounded; what is left
    # of the mails is one prefix per spot.
    nth = Window.partitionBy("label", "part").orderBy("key")
    return (
        keyed.join(F.broadcast(spots), ["label", "prefix"])
        .withColumn("row", F.row_number().over(nth))
        .where(F.col("row") == F.col("nth"))
        .groupBy("label")
        .agg(
            F.max(F.when(F.col("part") == "test", F.col("key"))).alias("test_end"),
            *[
                F.max(F.when(F.col("part") == f"fold_{f}", F.col("key"))).alias(f"fold_{f}_end")
                for f in range(folds - 1)
            ],
        )
    )


def with_parts(
    mails: DataFrame, ends: DataFrame, seed: int = SEED, folds: int = FOLDS
) -> DataFrame:
    """Add ``split`` (train/test) and ``fold`` (0.. for train, null for test)."""
    fold = F.lit(folds - 1)
    for f in reversed(range(folds - 1)):
        fold = F.when(F.col("_key") <= F.col(f"fold_{f}_end"), f).otherwise(fold)
    in_test = F.coalesce(F.col("_key") <= F.col("test_end"), F.lit(False))
    return (
        mails.withColumn("_key", order_key(seed))
        .join(F.broadcast(ends), "label", "left")  # one row per label
        .select(
            *mails.columns,
            F.when(in_test, "test").otherwise("train").alias("split"),
            F.when(~in_test, fold).alias("fold"),
        )
    )


def assign_parts(
    mails: DataFrame, seed: int = SEED, test_share: float = TEST_SHARE, folds: int = FOLDS
) -> DataFrame:
    """Stratified test part and folds, from the mails alone."""
    return with_parts(mails, part_ends(mails, seed, test_share, folds), seed, folds)


def split_counts(parts: DataFrame, by: str = "split") -> DataFrame:
    """Rows, ham and spam per value of ``by``."""
    return parts.groupBy(by).agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("label") == HAM).alias("ham"),
        F.count_if(F.col("label") == SPAM).alias("spam"),
    )


def split_label_counts(parts: DataFrame) -> DataFrame:
    """Rows per split and label, one row each."""
    return parts.groupBy("split", F.col("label_name").alias("label")).agg(
        F.count("*").alias("count")
    )


def label_counts(mails: DataFrame) -> DataFrame:
    """Mails per label and in total."""
    return (
        mails.rollup("label_name")
        .agg(F.count("*").alias("raw_file_count"))
        .select(F.coalesce("label_name", F.lit("total")).alias("label"), "raw_file_count")
    )


def sample_mail(mails: DataFrame, label: str, seed: int = SEED) -> DataFrame:
    """One mail of a label, drawn by seeded digest."""
    return (
        mails.where(F.col("label_name") == label)
        .withColumn("_key", order_key(seed))
        .orderBy("_key", "id")
        .limit(1)
        .drop("_key")
    )


def parse_preview(mails: DataFrame) -> DataFrame:
    """The first mail by path of each label: its parsed subject, raw and cleaned beginnings.

    Mails that came without a subject have an empty one.
    """
    subject = F.coalesce("subject", F.lit("")) if "subject" in mails.columns else F.lit("")
    first = mails.groupBy("label_name").agg(
        F.min(F.struct("path", "id")).alias("first")
    ).select("first.id")
    chosen = mails.join(F.broadcast(first), "id")  # one row per label
    return clean_text(chosen).select(
        F.col("label_name").alias("label"),
        F.element_at(F.split("path", "/"), -1).alias("file"),
        F.substring(subject, 1, 120).alias("subject"),
        F.substring("text", 1, 240).alias("raw_preview"),
        F.substring("clean", 1, 240).alias("clean_preview"),
    )
