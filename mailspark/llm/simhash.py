"""SimHash near duplicates by meet-in-the-middle ball hashing.

Two fingerprints at three or fewer differing bits have a common point that is at most
one bit from the one and two from the other.  So every distinct fingerprint emits the
points around it, points are brought together, and fingerprints that share one are
linked.

* *Fewer points.* Fingerprints at an odd distance differ in the parity of their bits,
  and those at two bits meet at one bit from both.  So one bit around all of them and
  two bits around those of even parity are enough.
* *Small shuffle.* Points are not shuffled one by one: a fingerprint is sent once to
  every bucket (some chosen bits of a point) that holds a point of its ball, and the
  task with the bucket generates the points in it again.  The chosen bits are the most
  even ones, and their number follows the number of fingerprints.
* *No pairs of a group.* All that share a point are linked to one of them that is at
  most a bit away from it, hence within three bits of every one.  Links are checked,
  made distinct, and reduced to a forest before they leave the task.
* *Components* are found by star contraction on tables in the shared folder.

Rows: a null or empty text has the fingerprint zero, linked like any other; null ids
are no smallest id, and a component of null ids alone has a null id; repeated rows
share fingerprint and component; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailspark.llm.common import small_batches, text_slices, word_chunks
from mailspark.llm.components import components
from mailspark.sources.scratch import written

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
BITS = 64
#: Distinct fingerprints that a bucket shall hold in the mean.
PER_BUCKET = 64
#: Points looked up at a time in a bucket.
POINTS_AT_ONCE = 1 << 18


def hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of every shingle of ``size`` words joined by a space."""
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    first, last = starts[: len(words) - size + 1].tolist(), (ends[size - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(first, last)), np.uint64, len(first)
    )


def fingerprint(text: str, size: int = SHINGLE_WORDS) -> int:
    """Each bit is one where more than half of the shingles' hashes have it set."""
    counts, n, tail = np.zeros(BITS, np.int64), 0, []
    for words in word_chunks(text.encode().lower()):
        words = tail + words
        tail = words[len(words) - size + 1 :] if len(words) >= size else words
        if len(words) >= size:
            found = hashes(words, size)
            n += len(found)
            counts += bit_counts(found)
    if not n and tail:
        n, counts = 1, bit_counts(hashes(tail, len(tail)))
    value = np.packbits(2 * counts > n, bitorder="little").view(np.uint64)
    return int(value[0])


def bit_counts(values: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int32)


def fingerprints(
    docs: DataFrame, size: int = SHINGLE_WORDS, carry: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, the carried columns, and fp, the fingerprint as a signed long."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches, "text"):
            values = np.array([fingerprint(t, size) for t in texts], np.uint64)
            kept = ["doc_id", *carry]
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(c) for c in kept), pa.array(values.view(np.int64))], [*kept, "fp"]
            )

    docs = small_batches(docs).select("doc_id", *carry, "text")
    schema = ", ".join(f"`{n}` {t}" for n, t in docs.drop("text").dtypes)
    return docs.mapInArrow(run, f"{schema}, fp long")


def chosen_bits(points: DataFrame, n: int) -> list[int]:
    """The bits whose share of ones is nearest a half; more of them for more points."""
    wanted = min(BITS // 2, max(4, math.ceil(math.log2(max(n, 1) / PER_BUCKET + 1))))
    ones = points.agg(
        *(F.sum(F.getbit("fp", F.lit(i)).cast("long")).alias(f"b{i}") for i in range(BITS))
    ).first()
    return sorted(sorted(range(BITS), key=lambda i: (abs((ones[i] or 0) / max(n, 1) - 0.5), i))[:wanted])


def flips(bits: list[int], count: int) -> np.ndarray:
    """All patterns that set exactly ``count`` of the given bits."""
    return np.array(
        [sum(1 << b for b in some) for some in combinations(bits, count)], np.uint64
    )


def to_buckets(points: DataFrame, bits: list[int]) -> DataFrame:
    """(bucket, fp) for every bucket that holds a point of the fingerprint's ball."""
    mask = np.uint64(sum(1 << b for b in bits))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = np.concatenate([flips(bits, 0), flips(bits, 1)])
        ball = np.concatenate([near, flips(bits, 2)])
        for batch in batches:
            fps = batch.column("fp").to_numpy().view(np.uint64)
            even = np.bitwise_count(fps) % 2 == 0
            for some, moves in ((fps[even], ball), (fps[~even], near)):
                for at in range(0, len(some), 1 << 12):
                    own = some[at : at + (1 << 12)]
                    buckets = (own & mask)[:, None] ^ moves[None, :]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(buckets.ravel().view(np.int64)),
                            pa.array(np.repeat(own, len(moves)).view(np.int64)),
                        ],
                        ["bucket", "fp"],
                    )

    return points.mapInArrow(run, "bucket long, fp long")


def bucket_links(fps: np.ndarray, bucket: int, bits: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Links (from, to) between fingerprints that share a point of this bucket."""
    mask = np.uint64(sum(1 << b for b in bits))
    rest = [b for b in range(BITS) if not int(mask) >> b & 1]
    one, two = flips(rest, 1), flips(rest, 2)
    moved = (fps & ~mask) | np.uint64(bucket)
    away = np.bitwise_count(fps ^ moved)
    home = fps[away == 0]
    beside = away == 1
    points = np.concatenate([home, (home[:, None] ^ one[None, :]).ravel(), moved[beside]])
    owners = np.concatenate([home, np.repeat(home, len(one)), fps[beside]])
    if not len(points):
        return owners, owners
    far = np.ones(len(points), bool)
    far[: len(home)] = False
    order = np.lexsort((owners, far, points))
    points, owners = points[order], owners[order]
    new = np.concatenate([[True], points[1:] != points[:-1]])
    centres = owners[new]
    sources, targets = [owners], [centres[np.cumsum(new) - 1]]
    points = points[new]

    def meet(some: np.ndarray, moves: np.ndarray, whose: np.ndarray) -> None:
        step = max(1, POINTS_AT_ONCE // max(1, len(some)))
        for at in range(0, len(moves), step):
            probe = (some[None, :] ^ moves[at : at + step, None]).ravel()
            place = np.searchsorted(points, probe)
            place[place == len(points)] = 0
            hit = np.flatnonzero(points[place] == probe)
            sources.append(whose[hit % len(whose)])
            targets.append(centres[place[hit]])

    even = np.bitwise_count(fps) % 2 == 0
    meet(fps[even & (away == 0)], two, fps[even & (away == 0)])
    meet(moved[even & beside], one, fps[even & beside])
    meet(moved[even & (away == 2)], np.zeros(1, np.uint64), fps[even & (away == 2)])
    a, b = np.concatenate(sources), np.concatenate(targets)
    checked = (a != b) & (np.bitwise_count(a ^ b) <= MAX_BITS)
    return a[checked], b[checked]


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links with the same components, at most one per value: to the least value."""
    if not len(a):
        return a, b
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    pairs = np.unique(index[: len(a)] * len(nodes) + index[len(a) :])
    x, y = pairs // len(nodes), pairs % len(nodes)
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], least)
        np.minimum.at(new, label[y], least)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            break
        label = new
    inner = label != np.arange(len(nodes))
    return nodes[inner], nodes[label[inner]]


def links(points: DataFrame, bits: list[int]) -> DataFrame:
    """(a, b): links between distinct fingerprints, with the components of all links."""

    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        fps = group.column("fp").to_numpy().view(np.uint64)
        a, b = forest(*bucket_links(fps, key[0].as_py() % (1 << BITS), bits))
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return (
        to_buckets(points, bits)
        .groupBy("bucket")
        .applyInArrow(run, "a long, b long")
        .distinct()
    )


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: doc_id, fingerprint (hex), component_id, component.

    Fingerprints link at ``MAX_BITS`` or fewer differing bits.  ``component`` tells the
    components apart, also those without an id.  ``carry`` names further, narrow columns
    to return.
    """
    found = written(
        fingerprints(
            docs.select(
                F.col(id_column).cast("long").alias("doc_id"),
                F.col(text_column).cast("string").alias("text"),
                *carry,
            ),
            shingle_words,
            carry,
        ),
        "fingerprints",
    )
    points = written(
        found.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints"
    )
    n = points.count()
    pairs = written(links(points.select("fp"), chosen_bits(points, n)), "fingerprint-links")
    roots = components(pairs)
    classes = points.join(
        roots.select(F.col("node").alias("fp"), "root"), "fp", "left"
    ).withColumn("root", F.coalesce("root", "fp"))
    least = classes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = classes.join(least, "root").select("fp", "component_id", "root")
    return found.join(by_fp, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        F.col("root").alias("component"),
        *carry,
    )
