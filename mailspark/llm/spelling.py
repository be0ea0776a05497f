"""Grouping of spelling variants by a bit-sliced position index.

The vocabulary is laid out as bitsets: for every position and letter one bit per word,
set where the word has that letter there.  A query word is read letter by letter; after
each letter four bitsets hold, for all words of the index at once, which of them

- agree so far (zero errors),
- differ by one replaced letter,
- differ by one letter that only the query has, and so are read one place behind,
- differ by one letter that only the word has, and so are read one place ahead.

Each step is a few word-wide operations on these sets and on the bitsets of the query's
letter at its own, the earlier and the later position.

Sharding.  Two words at one error, the shorter of ``s`` letters, share their first or
their last ``s // 2`` letters.  So a word goes to four shards, as one of length ``s`` and
as a longer partner of words of length ``s - 1``, by its first and by its last half.
Shards are hashed to about ``SHARD`` words and are bounded: the words of a key that holds
more than that are dealt to blocks, and each block is searched by the words of each other.
A near pair is found once in each direction: in the shard of the first half if the words
agree in it, else in that of the last.  A shard gives one row per word with its number of
near words and the best of them, never the pairs.

Rows: null and empty texts have no words, and a null id counts as empty where words are
altered; whole texts are read however long; repeated rows count each; equal counts go to
the smallest word in code-point order; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailspark.llm.common import small_batches, text_slices
from mailspark.sources.scratch import written

LEAST_LETTERS = 7
LEAST_COUNT = 2
#: A word of one document in so many loses a letter.
ALTERED = 31
#: How often as common a near word has to be to count as the right form.
COMMONER = 10
#: Words of a shard on average, and letters of a shard at most where words are long.
SHARD = 4096
SHARD_LETTERS = 1 << 24
#: Words that a task counts before it hands them on.
COUNTED = 200_000
#: Words of 64 bits that a step holds for the queries it takes together.
BITS_AT_ONCE = 1 << 18

#: Bytes of Latin-1: A-Z in lower case, a-z and 0xC0-0xFF as they are, all else as spaces.
_LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0xC0 else 0x20
    for b in range(256)
)


def altered(run: bytes, seed: int) -> bytes:
    """A run (Latin-1) without one letter, if the hash of id and run says so."""
    h = crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
    if h % ALTERED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    letters: int = LEAST_LETTERS,
) -> DataFrame:
    """word, n: the runs of letters of all texts, some of them altered, with their counts."""

    def rows(totals: Counter) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in totals], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(totals.values(), pa.int64())], ["word", "n"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Counter = Counter()
        for batch, texts in text_slices(batches, "text"):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts):
                seed = crc32(f"{'' if doc_id is None else doc_id}:".encode())
                found = Counter(text.encode("latin-1", "replace").translate(_LETTERS).split())
                for word, n in found.items():
                    # Losing a letter never makes a short run long enough.
                    if len(word) >= letters:
                        word = altered(word, seed)
                        if len(word) >= letters:
                            totals[word] += n
            if len(totals) > COUNTED:
                yield rows(totals)
                totals = Counter()
        if totals:
            yield rows(totals)

    partial = small_batches(docs).select(
        F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text")
    ).mapInArrow(run, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


# --- the index of one shard ---------------------------------------------------


def bitset(flags: np.ndarray) -> np.ndarray:
    """Rows of flags as rows of 64-bit words, the first flag in the lowest bit."""
    width = -(-flags.shape[-1] // 64) * 8
    packed = np.packbits(flags, axis=-1, bitorder="little")
    spare = [(0, 0)] * (flags.ndim - 1) + [(0, width - packed.shape[-1])]
    return np.ascontiguousarray(np.pad(packed, spare)).view(np.uint64)


def letter_codes(words: list[bytes], width: int) -> np.ndarray:
    """Letters (word, position), zero beyond a word's end."""
    return np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)


class PositionIndex:
    """Bitsets over some words for each position and letter; a position's are made when
    it is asked for, and the last three are kept, as no step reads others."""

    def __init__(self, words: list[bytes], width: int):
        self.codes = letter_codes(words, width) if words else np.zeros((0, width), np.uint8)
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.width = width
        self.words64 = -(-len(words) // 64)
        self.kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def holding(self, position: int, letters: np.ndarray) -> np.ndarray:
        """Per query letter the words that have it at the position."""
        if not 0 <= position < self.width:
            return np.zeros((len(letters), self.words64), np.uint64)
        if position not in self.kept:
            column = self.codes[:, position]
            present = np.unique(column[column > 0])
            planes = np.zeros((len(present) + 1, self.words64), np.uint64)
            planes[1:] = bitset(column[None, :] == present[:, None])
            rows = np.zeros(256, np.int64)
            rows[present] = np.arange(1, len(present) + 1)
            self.kept = {p: x for p, x in self.kept.items() if position - 3 < p}
            self.kept[position] = (planes, rows)
        planes, rows = self.kept[position]
        return planes[rows[letters]]

    def longer_than(self, n: int) -> np.ndarray:
        return bitset(self.lengths > n)

    def of_length(self, n: int) -> np.ndarray:
        return bitset(self.lengths == n)


def near_words(index: PositionIndex, queries: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """Bitsets (query, words) of the words at one error from queries of one length.

    The second result tells which words agree with a query in the first ``half`` letters.
    """
    count, length = queries.shape
    none = np.zeros((count, index.words64), np.uint64)
    equal = none | bitset(np.ones(len(index.lengths), bool))
    replaced, behind, ahead, agreeing = none, none, none, equal
    for i in range(length):
        letters = queries[:, i]
        there = index.longer_than(i)
        here = index.holding(i, letters)
        skipped = equal & there
        ahead = (ahead | skipped) & index.holding(i + 1, letters)
        behind = (behind & index.holding(i - 1, letters)) | equal
        replaced = (replaced & here) | (skipped & ~here)
        equal = equal & here
        if i + 1 == half:
            agreeing = equal
    ahead = ahead | (equal & index.longer_than(length))
    near = (
        (replaced & index.of_length(length))
        | (behind & index.of_length(length - 1))
        | (ahead & index.of_length(length + 1))
    )
    return near, agreeing


def first_bits(sets: np.ndarray) -> np.ndarray:
    """The number of the lowest bit of each row, which has one."""
    place = (sets != 0).argmax(axis=1)
    word = sets[np.arange(len(sets)), place]
    return place * 64 + np.bitwise_count((word & (~word + np.uint64(1))) - np.uint64(1))


# --- shards -------------------------------------------------------------------


def shard_rows(words: DataFrame, letters: int = LEAST_LETTERS, size: int = SHARD) -> DataFrame:
    """(s, kind, shard, i, j, word, n, held, asked): what each shard has to do.

    ``held`` words are in the index of the shard, ``asked`` ones are looked up in it.
    """
    length = F.length("word")
    lengths = F.filter(F.array(length, length - 1), lambda s: s >= letters)
    halves = words.select("word", "n", F.explode(lengths).alias("s")).withColumn(
        "half", F.floor(F.col("s") / 2).cast("int")
    )
    ends = F.array(
        F.struct(F.lit(0).alias("kind"), F.expr("left(word, half)").alias("key")),
        F.struct(F.lit(1).alias("kind"), F.expr("right(word, half)").alias("key")),
    )
    keyed = halves.select("word", "n", "s", F.inline(ends)).select(
        "word", "n", "s", "kind", F.xxhash64("s", "kind", "key").alias("key")
    )
    room = F.least(F.lit(size), F.greatest(F.lit(1), F.floor(F.lit(SHARD_LETTERS) / F.col("s"))))
    keys = written(
        keyed.groupBy("s", "kind", "key").agg(F.count("*").alias("rows")).withColumn("room", room),
        "spelling-keys",
    )
    # One row per length and kind, and one per key that no shard can hold.
    shards = keys.groupBy("s", "kind").agg(
        F.ceil(F.sum("rows") / F.first("room")).alias("shards")
    )
    large = keys.where("rows > room").select(
        "key", F.ceil(F.col("rows") / F.col("room")).cast("int").alias("blocks")
    )
    placed = (
        keyed.join(written(shards, "spelling-shards"), ["s", "kind"])
        .join(written(large, "spelling-large-keys"), "key", "left")
        .withColumn("own", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
        .withColumn(
            "shard",
            F.when(F.col("blocks").isNull(), F.pmod("key", F.col("shards"))).otherwise(F.col("key")),
        )
    )
    both = F.array(
        F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(True).alias("held"), F.lit(True).alias("asked"))
    )
    others = F.flatten(
        F.transform(
            F.sequence(F.lit(0), F.col("blocks") - 1),
            lambda b: F.when(
                b == F.col("own"),
                F.array(F.struct(b.alias("i"), b.alias("j"), F.lit(True).alias("held"), F.lit(True).alias("asked"))),
            ).otherwise(
                F.array(
                    F.struct(F.col("own").alias("i"), b.alias("j"), F.lit(True).alias("held"), F.lit(False).alias("asked")),
                    F.struct(b.alias("i"), F.col("own").alias("j"), F.lit(False).alias("held"), F.lit(True).alias("asked")),
                )
            ),
        )
    )
    roles = F.when(F.col("blocks").isNull(), both).otherwise(others)
    return placed.select("s", "kind", "shard", "word", "n", F.inline(roles))


FOUND = "word string, near long, form string, form_n long"


def shard_matches(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
    """Per word of a shard that has near words there: their number and the best of them."""
    s, kind = key[0].as_py(), key[1].as_py()
    words = np.array([w.encode("latin-1") for w in group.column("word").to_pylist()], object)
    counts = group.column("n").to_numpy()
    held = np.flatnonzero(group.column("held").to_numpy(zero_copy_only=False))
    # The commonest first, so that the lowest bit of a set is the best word in it.
    held = np.array(sorted(held, key=lambda r: (-counts[r], words[r])), np.int64)
    index = PositionIndex([words[r] for r in held], s + 1)
    asked = np.flatnonzero(group.column("asked").to_numpy(zero_copy_only=False))
    short = index.of_length(s)
    rows: list[tuple[np.ndarray, ...]] = []
    step = max(1, BITS_AT_ONCE // max(1, index.words64))
    for length in (s, s + 1):
        mine = np.array([r for r in asked if len(words[r]) == length], np.int64)
        for at in range(0, len(mine) if len(held) else 0, step):
            some = mine[at : at + step]
            near, agreeing = near_words(index, letter_codes(list(words[some]), length), s // 2)
            near = near & (agreeing if kind == 0 else ~agreeing)
            if length > s:
                near = near & short  # two longer words meet in the next length
            hit = np.flatnonzero(near.any(axis=1))
            if len(hit):
                best = held[first_bits(near[hit])]
                rows.append((some[hit], np.bitwise_count(near[hit]).sum(axis=1), best))
            index.kept.clear()
    if not rows:
        return pa.table({"word": [], "near": [], "form": [], "form_n": []}, schema=FOUND_ARROW)
    mine, near, best = (np.concatenate(x) for x in zip(*rows))
    name = group.column("word")
    return pa.table(
        [name.take(pa.array(mine)), pa.array(near.astype(np.int64)), name.take(pa.array(best)), pa.array(counts[best])],
        schema=FOUND_ARROW,
    )


FOUND_ARROW = pa.schema(
    [("word", pa.string()), ("near", pa.int64()), ("form", pa.string()), ("form_n", pa.int64())]
)


def forms(words: DataFrame, letters: int = LEAST_LETTERS, size: int = SHARD) -> DataFrame:
    """word, n, n_near, form, form_n of words (word, n); form is null where none is commoner."""
    found = (
        shard_rows(words, letters, size)
        .groupBy("s", "kind", "shard", "i", "j")
        .applyInArrow(shard_matches, FOUND)
        .groupBy("word")
        .agg(
            F.sum("near").alias("n_near"),
            F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best"),
        )
    )
    right = -F.col("best.less") >= COMMONER * F.col("n")
    return words.join(found, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(right, F.col("best.form")).alias("form"),
        F.when(right, -F.col("best.less")).alias("form_n"),
    )


def with_roots(table: DataFrame) -> DataFrame:
    """Adds ``root``: the last word that is reached by following forms.

    A form is ``COMMONER`` times as common as its word, so chains are as short as the
    logarithm of the largest count; each round doubles the steps taken.
    """
    largest = table.agg(F.max("n")).first()[0] or 1
    steps = max(1, math.floor(math.log(largest, COMMONER)))
    links = table.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps)) + 1):
        links = written(links, "spelling-links")
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = links.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root")
        )
    return table.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    letters: int = LEAST_LETTERS, size: int = SHARD,
) -> DataFrame:
    """word, form, root, n, n_near, form_n of all words of the documents."""
    counted = word_counts(docs, id_column, text_column, letters)
    words = written(counted.where(F.col("n") >= LEAST_COUNT), "spelling-words")
    table = written(forms(words, letters, size), "spelling-forms")
    return with_roots(table).select("word", "form", "root", "n", "n_near", "form_n")
