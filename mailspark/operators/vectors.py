"""Numbers of terms, and sparse feature vectors for MLlib, built from the long tables."""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailspark.config import FeatureConfig
from mailspark.operators.features import tfidf
from mailspark.sources.scratch import written

INDEX_BUCKETS = 4096
LARGEST_INDEX = (1 << 31) - 1


def with_index(vocab: DataFrame) -> DataFrame:
    """Number the terms 0, 1, … without sorting them all in one place.

    Terms are numbered inside hash buckets; a bucket starts where the earlier
    ones end.
    """
    placed = vocab.withColumn(
        "_bucket", F.pmod(F.xxhash64("token"), F.lit(INDEX_BUCKETS))
    )
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_bucket")
        .agg(F.count("*").alias("n"))
        .select("_bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_start"))
    )  # at most INDEX_BUCKETS rows
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy("token"))
    return placed.join(F.broadcast(starts), "_bucket").select(
        *vocab.columns, (F.col("_start") + inside - 1).cast("int").alias("index")
    )


def feature_vectors(
    docs: DataFrame, vocab: DataFrame, size: int, config: FeatureConfig
) -> DataFrame:
    """``docs`` with ``terms`` replaced by ``features``, written once for the solvers.

    The table is written as the plain struct a vector is stored as and read back
    as vectors, so no row passes through Python.
    """
    kept = [f for f in docs.schema.fields if f.name != "terms"]
    cells = (
        tfidf(docs.select("id", "terms"), vocab, config, ("index",))
        .groupBy("id")
        .agg(F.sort_array(F.collect_list(F.struct("index", "weight"))).alias("cells"))
    )  # one mail's terms per row
    cells_or_none = F.coalesce(
        F.col("cells"), F.array().cast("array<struct<index:int,weight:double>>")
    )
    vector = F.struct(
        F.lit(0).cast("byte").alias("type"),
        F.lit(size).alias("size"),
        F.transform(cells_or_none, lambda c: c["index"]).alias("indices"),
        F.transform(cells_or_none, lambda c: c["weight"]).alias("values"),
    )
    names = [f.name for f in kept]
    table = docs.select(*names).join(cells, "id", "left").select(*names, vector.alias("features"))
    schema = T.StructType([*kept, T.StructField("features", VectorUDT())])
    return written(table, "vectors", schema)


def checked_size(size: int) -> int:
    """The size of a vocabulary, which MLlib's vectors must be able to index."""
    if size > LARGEST_INDEX:
        raise ValueError(f"{size} terms; MLlib's vectors hold {LARGEST_INDEX}: raise min_df")
    return size
