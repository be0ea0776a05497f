"""Which terms drive a linear model."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mailspark.config import FeatureConfig
from mailspark.operators.blocks import Blocks, cells_of, term_blocks

#: More than rounding changes in a contribution.
SLACK = 1e-10


def token_contributions(
    docs: DataFrame | Blocks, weights: DataFrame, config: FeatureConfig, k: int = 12
) -> DataFrame:
    """Per mail, the ``k`` terms with the highest and the ``k`` with the lowest
    contribution (tf-idf weight times ``weights.weight``).

    ``weights`` has token, idf, weight.  The two lists may share terms of a short
    mail; a mail without known terms has none.  A block hands on what may be among the
    terms of a mail when contributions are rounded; the sorts are per mail.
    """
    blocks = docs if isinstance(docs, Blocks) else term_blocks(docs.select("id", "terms"))
    held = blocks.terms.select("block", "code", "token").join(weights, "token").select("block", "code", "token", "idf", "weight")
    parts = (
        blocks.mails.select("block", "id", "cells", "codes", "counts")
        .groupBy("block")
        .cogroup(held.groupBy("block"))
        .applyInArrow(_extremes(config, k), "id string, token string, contribution double")
        .withColumn("contribution", F.round("contribution", 12))
    )
    high = Window.partitionBy("id").orderBy(F.desc("contribution"), "token")
    low = Window.partitionBy("id").orderBy("contribution", "token")
    ranked = parts.select(
        "id",
        "token",
        "contribution",
        F.row_number().over(high).alias("_high"),
        F.row_number().over(low).alias("_low"),
    )
    sides = F.array(
        F.struct(F.lit("spam").alias("side"), F.col("_high").alias("place")),
        F.struct(F.lit("ham").alias("side"), F.col("_low").alias("place")),
    )
    return (
        ranked.where((F.col("_high") <= k) | (F.col("_low") <= k))
        .select("id", "token", "contribution", F.inline(sides))
        .where(F.col("place") <= k)
        .select("id", "side", "place", "token", "contribution")
    )


def _extremes(config: FeatureConfig, k: int):
    """The cells of each mail that are not clearly behind its ``k`` highest or lowest."""

    def work(mails: pa.Table, terms: pa.Table) -> pa.Table:
        x = cells_of(mails, terms, config)
        w = x.tf * x.column("idf")[x.row]
        found = w / x.lengths(w, config)[x.group] * x.column("weight")[x.row]
        kept = np.zeros(len(found), bool)
        sizes = np.bincount(x.group, minlength=len(x.groups))
        starts = np.cumsum(sizes) - sizes
        for sign in (1, -1):
            order = np.lexsort((-sign * found, x.group))
            if len(order):
                last = order[np.maximum(starts + np.minimum(sizes, k) - 1, 0)]
                kept |= sign * found >= sign * found[last][x.group] - SLACK
        rows = np.flatnonzero(kept)
        return pa.table(
            {
                "id": x.mails.column("id").take(pa.array(x.mail[rows])),
                "token": terms.column("token").take(pa.array(x.row[rows])),
                "contribution": pa.array(found[rows]),
            }
        )

    return work


def top_tokens(weights: DataFrame, k: int = 15) -> DataFrame:
    """The ``k`` highest and lowest weighted terms of a linear model."""
    found = []
    for side, order in (("spam", F.desc("weight")), ("ham", F.asc("weight"))):
        rounded = weights.select("token", F.round("weight", 12).alias("weight"))
        top = rounded.orderBy(order, "token").limit(k)
        place = F.row_number().over(Window.orderBy(order, "token"))  # k rows
        found.append(top.select(F.lit(side).alias("side"), place.alias("place"), "token", "weight"))
    return found[0].unionByName(found[1])
