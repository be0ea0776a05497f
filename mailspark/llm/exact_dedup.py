"""Exact duplicates through integer names of blocks.

Every text is cut into blocks of a fixed number of characters.  The distinct blocks
are sorted and named by their rank; then the names of neighbouring blocks are paired, the
distinct pairs sorted and named again, and so on until each text has one name.  Texts of
the same number of levels are equal exactly when their names are.  Names follow from the
texts alone, not from how rows lie in partitions.

* Each text crosses the network once, as blocks that were made distinct on the map
  side, so a text copied into a third of all rows is sent once per task.
* Everything else moves 128-bit keys and integers.  A key stands for a block only
  after the naming has found that no two blocks share it; should two ever do, the
  naming starts again with other keys.  So no result rests on a hash.  Blocks are sorted
  by their first characters and then by key, so that no block is moved again for it.
* Tables in the shared folder cut the lineage between levels.

Everything runs as DataFrame and SQL functions.

Rows: a null text is an empty one; a null id counts as larger than any other; rows
that repeat an id are rows of their own, each returned; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailspark.llm.common import SPACE, hex_sha256
from mailspark.sources.scratch import written

#: Characters in a block.
BLOCK = 4096
#: Characters of a block that it is sorted by before its key.
HEAD = 16
#: Keys are drawn anew at most so often before the naming gives up.
TRIES = 8
#: Bits of a row's place within its partition, in the numbers Spark gives to rows.
PLACE_BITS = 33


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def blocks_of(text: Column, size: int = BLOCK) -> Column:
    """The blocks of a text in order; an empty text has one empty block."""
    found = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    return F.when(text == "", F.array(F.lit(""))).otherwise(found)


def block_key(block: Column, seed: int) -> Column:
    """128 bits of a block."""
    return F.struct(
        F.xxhash64(F.lit(seed), block).alias("a"), F.xxhash64(F.lit(seed + 1), block).alias("b")
    )


def block_names(docs: DataFrame, size: int, seed: int, key=block_key) -> DataFrame | None:
    """(key, name) of each distinct block, or None if two blocks share a key."""
    found = (
        docs.select(F.explode(blocks_of(F.col("text"), size)).alias("block"))
        .select(key(F.col("block"), seed).alias("key"), "block")
        .groupBy("key")
        .agg(F.collect_set("block").alias("blocks"))
    )
    names = written(
        found.select(
            "key",
            F.size("blocks").alias("n"),
            F.substring(F.col("blocks")[0], 1, HEAD).alias("head"),
        ),
        "blocks",
    )
    if names.where("n > 1").head(1):
        return None
    return ranked(names.select("key", "head"), "head", "key.a", "key.b").select("key", "name")


def ranked(rows: DataFrame, *order: str) -> DataFrame:
    """Adds ``name``: the rank of a row, from 0, in an order that tells all rows apart.

    Rows are dealt by range and sorted there; a range begins where the earlier ones end.
    """
    placed = written(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id()),
        "sorted",
    )
    part, place = F.shiftright("place", PLACE_BITS), F.col("place").bitwiseAND((1 << PLACE_BITS) - 1)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = (
        placed.groupBy(part.alias("part"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("begin"))
    )  # one row per partition
    return (
        placed.withColumn("part", part)
        .join(F.broadcast(begins), "part")
        .withColumn("name", F.col("begin") + place)
        .drop("part", "begin", "place")
    )


def identities(
    docs: DataFrame, size: int = BLOCK, key=block_key, carry: tuple[str, ...] = ()
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): row, doc_id, text_sha256, levels, name."""
    clean = docs.select("doc_id", normalised(F.col("text")).alias("text"), *carry)
    for seed in range(0, 2 * TRIES, 2):
        names = block_names(clean, size, seed, key)
        if names is not None:
            break
    else:
        raise RuntimeError(f"{TRIES} kinds of keys all failed to tell the blocks apart")
    rows = written(
        clean.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            *carry,
            hex_sha256(F.col("text")).alias("text_sha256"),
            F.transform(blocks_of(F.col("text"), size), lambda b: key(b, seed)).alias("keys"),
        ),
        "block-keys",
    )
    length = F.size("keys")
    level = written(
        rows.select("row", length.alias("length"), F.posexplode("keys").alias("pos", "key"))
        .join(names, "key")
        .select("row", "length", "pos", "name"),
        "level-0",
    )
    done = [level.where("length = 1").select("row", F.lit(0).alias("levels"), "name")]
    while (level := level.where("length > 1")).head(1):
        n = len(done)
        pairs = level.groupBy(
            "row",
            F.ceil(F.col("length") / 2).cast("int").alias("length"),
            F.floor(F.col("pos") / 2).cast("int").alias("pos"),
        ).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias(
                "right"
            ),
        )
        names = written(
            ranked(written(pairs.select("left", "right").distinct(), f"pairs-{n}"), "left", "right"),
            f"pair-names-{n}",
        )
        level = written(
            pairs.join(names, ["left", "right"]).select("row", "length", "pos", "name"),
            f"level-{n}",
        )
        done.append(level.where("length = 1").select("row", F.lit(n).alias("levels"), "name"))
    found = done[0]
    for part in done[1:]:
        found = found.unionByName(part)
    return rows.drop("keys").join(found, "row")


def exact_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    size: int = BLOCK,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256, and its identity.

    Of rows that repeat both the text and the smallest id, one is kept.  ``carry`` names
    further, narrow columns to return.
    """
    found = written(
        identities(
            docs.select(
                F.col(id_column).cast("long").alias("doc_id"),
                F.col(text_column).cast("string").alias("text"),
                *carry,
            ),
            size,
            carry=carry,
        ),
        "identities",
    )
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    groups = found.groupBy("levels", "name").agg(
        F.count(F.lit(1)).alias("group_size"), F.min(first).alias("first")
    )
    # Written, so that the join is dealt on its own and a large group can be split there.
    many = written(groups.where("group_size > 1"), "copies")
    joined = found.join(many, ["levels", "name"], "left")
    return joined.select(
        "doc_id",
        F.when(F.col("first").isNull(), F.col("doc_id"))
        .otherwise(F.col("first.doc_id"))
        .alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("first.row") == F.col("row"), F.lit(True)).alias("kept"),
        "text_sha256",
        "row",
        "levels",
        "name",
        *carry,
    )
