"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailspark.sources.scratch import written


def _state(links: DataFrame) -> tuple:
    row = links.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every value in links (a, b): root is the least value connected.

    Star contraction: every value's larger neighbours are linked to its least
    neighbour, then its smaller ones, until each link leads to a root.  The number of
    rounds grows with the logarithm of the longest path.  Minima combine before the
    shuffle, so a value with very many neighbours is no hot group; every round is
    written to the shared folder.
    """
    links = links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    links = written(links.distinct(), "links")
    before, n = _state(links), 0
    while before[0]:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        large = written(large.where("a <> b").distinct(), f"large-star-{n}")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(
            F.col("b").alias("a"), F.col("m").alias("b")
        )
        small = small.unionByName(least.select("a", F.col("m").alias("b")))
        links = written(small.distinct(), f"small-star-{n}")
        after, n = _state(links), n + 1
        if after == before:
            break
        before = after
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )
