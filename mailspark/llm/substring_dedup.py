"""Repeated passages across documents, by an FM-index per shard.

A window is a run of words of a fixed number.  A word is removed where it lies in a
window whose words also begin in a document with a smaller id.

* *Segments.* The least hash of the short word runs within a window is its key.  Windows
  with one key follow one another, so a document falls into segments of some 20 windows;
  equal windows have equal keys.  Keys and hashes of segments are narrow rows; words
  are only sent on for keys that several documents share.
* *Equal segments* (equal key and 64-bit hash) are counted once, on the map side first:
  that of the smallest document stands for all; in the others all of it is removed.
* *Shards.* The remaining segments meet by key.  Each task cuts its keys into shards of
  bounded size.  Within a shard a key's segments are halved in order of their documents,
  and the halves again: the smaller documents' half is indexed, the other half, which is
  not in the index, is streamed through it.  Backward search gives matching statistics,
  and where a match reaches the window, the smallest document that has it.
* *Hot keys.* A passage in very many documents can give a key more segments than a
  shard holds.  Windows with such keys meet one by one, by 128 bits of their words, and
  combine on the map side, so no task gathers a key's segments.

Rows: a null text has no words; a null id counts as larger than any other; rows that
repeat an id are documents of their own, none smaller than the other, and rows that
repeat a text too get one result each; an empty table gives no rows; other columns are
not read.  Memory grows with the longest text, some 100 bytes for each of its words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailspark.llm.common import small_batches, text_slices
from mailspark.llm.fm_index import FMIndex
from mailspark.sources.scratch import written

WINDOW = 50
#: Words of the short runs whose least hash is a window's key.
RUN = 12
#: Words in a shard, where a key's segments allow.
SHARD_WORDS = 1_000_000
#: Keys with more different segments are hot.
HOT_SEGMENTS = 10_000
LAST = (1 << 63) - 1
#: Words whose hash a worker remembers; only speed depends on it.
REMEMBERED = 400_000

_U = np.uint64
# Odd factors of the rolling hashes.
_STEP = 0x9E3779B97F4A7C15
_TURN = 0xD6E8FEB86659FD93


class _Known(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_WORDS = _Known()


def hashed(words: list[bytes]) -> np.ndarray:
    if len(_WORDS) > REMEMBERED:
        _WORDS.clear()
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(29))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(32))


def run_hashes(hashes: np.ndarray, size: int, factor: int = _STEP) -> np.ndarray:
    """The hash of every run of ``size`` words."""
    n = len(hashes) - size + 1
    found = np.zeros(max(0, n), np.uint64)
    for k in range(size):
        found = found * _U(factor) + hashes[k : k + max(0, n)]
    return mixed(found)


def span_hashes(hashes: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """The hash of every span of words, from one prefix sum."""
    n = len(hashes) + 1
    power = np.full(n, _TURN, np.uint64)
    power[:1] = 1
    power = np.multiply.accumulate(power)
    inverse = np.full(n, pow(_TURN, -1, 1 << 64), np.uint64)
    inverse[:1] = 1
    inverse = np.multiply.accumulate(inverse)
    total = np.zeros(n, np.uint64)
    np.cumsum(hashes * power[:-1], out=total[1:])
    spans = (total[stops] - total[starts]) * inverse[starts]
    return mixed(spans + (stops - starts).astype(np.uint64))


def least_within(values: np.ndarray, size: int) -> np.ndarray:
    """The least of every ``size`` neighbours."""
    found, width = values, 1
    while 2 * width <= size:
        found, width = np.minimum(found[:-width], found[width:]), 2 * width
    rest = size - width
    return np.minimum(found[: len(found) - rest], found[rest:])


def segments(hashes: np.ndarray, sizes: np.ndarray, window: int, run: int) -> dict:
    """Segments of all texts: text, start, windows, key and hash of the words."""
    empty = np.zeros(0, np.int64)
    if len(hashes) < window:
        return dict(text=empty, start=empty, windows=empty, key=empty, seg=empty)
    text = np.repeat(np.arange(len(sizes)), sizes)
    first = np.cumsum(sizes) - sizes
    key = least_within(run_hashes(hashes, run), window - run + 1)
    whole = text[: len(key)] == text[window - 1 :]
    place = np.flatnonzero(whole)
    if not len(place):
        return dict(text=empty, start=empty, windows=empty, key=empty, seg=empty)
    key, owner = key[place], text[place]
    new = np.append(True, (key[1:] != key[:-1]) | (owner[1:] != owner[:-1]))
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(place)))
    start = place[begin]
    seg = span_hashes(hashes, start, start + count + window - 1)
    return dict(
        text=owner[begin],
        start=start - first[owner[begin]],
        windows=count,
        key=key[begin].view(np.int64),
        seg=seg.view(np.int64),
    )


def _list(rows: np.ndarray, n: int, columns: dict[str, np.ndarray]) -> pa.ListArray:
    """One list of structs for each of ``n`` rows, from columns in order of row."""
    offsets = np.searchsorted(rows, np.arange(n + 1)).astype(np.int32)
    values = pa.StructArray.from_arrays([pa.array(v) for v in columns.values()], list(columns))
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def scanned(docs: DataFrame, window: int = WINDOW, run: int = RUN) -> DataFrame:
    """Of each row: its key (ord, text_key), n_words, sha256 of its words, segments."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches, "text"):
            words = [t.encode().split() for t in texts]
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            found = segments(hashed([w for x in words for w in x]), sizes, window, run)
            owner = found.pop("text")
            digests = [hashlib.sha256(b" ".join(w)).hexdigest() for w in words]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("ord"),
                    rows.column("text_key"),
                    pa.array(sizes),
                    pa.array(digests, pa.string()),
                    _list(owner, len(words), found),
                ],
                ["ord", "text_key", "n_words", "words_sha256", "segments"],
            )

    return docs.select("ord", "text_key", "text").mapInArrow(
        scan,
        "ord long, text_key long, n_words long, words_sha256 string, "
        "segments array<struct<start: long, windows: long, key: long, seg: long>>",
    )


def shared(rows: DataFrame) -> DataFrame:
    """Segments whose key two documents have: row, start, windows, key, least, hot.

    least: the smallest document with an equal segment.
    """
    found = rows.select("ord", "text_key", F.inline("segments"))
    same = found.groupBy("key", "seg").agg(F.min("ord").alias("least"), F.max("ord").alias("most"))
    keys = (
        same.groupBy("key")
        .agg(
            F.min("least").alias("least"),
            F.max("most").alias("most"),
            (F.count(F.lit(1)) > HOT_SEGMENTS).alias("hot"),
        )
        .where("least < most")
        .select("key", "hot")
    )
    return written(
        found.join(same.join(keys, "key").select("key", "seg", "least", "hot"), ["key", "seg"]),
        "shared-segments",
    )


RANGES = "ord long, text_key long, start long, stop long"


def first_segments(texts: DataFrame, window: int) -> DataFrame:
    """The words of the segments that stand for their equals, to be indexed."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, found in text_slices(batches, "text"):
            out: list[tuple] = []
            for ord_, text_key, text, segs in zip(
                rows.column("ord").to_pylist(),
                rows.column("text_key").to_pylist(),
                found,
                rows.column("segments").to_pylist(),
            ):
                segs = [s for s in segs if s["least"] == ord_ and not s["hot"]]
                words = text.encode().split() if segs else []
                for s in segs:
                    a = s["start"]
                    own = b" ".join(words[a : a + s["windows"] + window - 1])
                    out.append((s["key"], ord_, text_key, a, own.decode()))
            columns = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 4 + [pa.string()])],
                ["key", "ord", "text_key", "start", "words"],
            )

    return texts.mapInArrow(cut, "key long, ord long, text_key long, start long, words string")


def shard_ranges(
    words: list[list[bytes]], owners: list[int], window: int, keys: list[int] | None = None
) -> list[list[tuple[int, int]]]:
    """Of each segment the ranges of windows that a smaller owner's segment has too.

    Equal windows have equal keys.  Two segments of a key differ in some
    bit of their places by owner; at the highest one the former is indexed and the latter
    streamed.  A segment all of whose windows a smaller owner has holds no first occurrence
    and takes no further part.
    """
    number: dict[bytes, int] = {}
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    tokens = np.zeros(int(sizes.sum()) + len(words), np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1
    for begin, text in zip(begins.tolist(), words):
        tokens[begin : begin + len(text)] = [number.setdefault(w, len(number) + 1) for w in text]
    owner = np.array(owners, np.int64)
    key = np.zeros(len(words), np.int64) if keys is None else np.array(keys, np.int64)
    by = np.lexsort((owner, key))
    new = np.append(True, key[by][1:] != key[by][:-1])[: len(by)]
    place = np.empty(len(by), np.int64)
    place[by] = np.arange(len(by)) - np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))
    count = np.empty(len(by), np.int64)
    group = np.cumsum(new) - 1
    count[by] = np.bincount(group)[group] if len(by) else 0
    owner_of = np.repeat(owner, sizes + 1)
    repeated = np.zeros(len(tokens), bool)
    for bit in range(int(count.max(initial=1) - 1).bit_length()):
        before = np.concatenate([[0], np.cumsum(repeated)])
        ends = np.maximum(begins, begins + sizes - window + 1)
        first = before[ends] - before[begins] < ends - begins
        streamed = np.flatnonzero((place >> bit & 1 == 1) & first)
        held = (place >> bit & 1 == 0) & (count > 1 << bit) & first
        if not (len(streamed) and held.any()):
            continue
        inside = np.repeat(held, sizes + 1)
        index = FMIndex(tokens[inside], owner_of[inside], window, len(number) + 1)
        _, least = index.matches(tokens, begins[streamed], sizes[streamed])
        repeated |= (least >= 0) & (least < owner_of)
    found = []
    for begin, size in zip(begins.tolist(), sizes.tolist()):
        own = repeated[begin : begin + max(0, size - window + 1)]
        edges = np.flatnonzero(np.diff(np.concatenate([[0], own, [0]]))).tolist()
        found.append(list(zip(edges[::2], edges[1::2])))
    return found


def indexed(firsts: DataFrame, window: int) -> DataFrame:
    """Ranges of windows found by the index of the segments' shard."""

    def answer(rows: list[tuple]) -> pa.RecordBatch:
        words = [r[4].encode().split() for r in rows]
        ranges = shard_ranges(words, [r[1] for r in rows], window, [r[0] for r in rows])
        out = [
            (ord_, text_key, start + a, start + b)
            for (_, ord_, text_key, start, _), found in zip(rows, ranges)
            for a, b in found
        ]
        columns = list(zip(*out)) or [()] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], ["ord", "text_key", "start", "stop"]
        )

    def shards(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size, key = 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= SHARD_WORDS and row[0] != key:
                    yield answer(rows)
                    rows, size = [], 0
                key = row[0]
                rows.append(row)
                size += row[4].count(" ") + 1
        if rows:
            yield answer(rows)

    return firsts.repartition("key").sortWithinPartitions("key").mapInArrow(shards, RANGES)


def hot_ranges(texts: DataFrame, window: int) -> DataFrame:
    """Ranges of the windows with hot keys, which meet one by one."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, found in text_slices(batches, "text"):
            for ord_, text_key, text, segs in zip(
                rows.column("ord").to_pylist(),
                rows.column("text_key").to_pylist(),
                found,
                rows.column("segments").to_pylist(),
            ):
                segs = [s for s in segs if s["hot"]]
                if not segs:
                    continue
                hashes = hashed(text.encode().split())
                place = np.concatenate(
                    [np.arange(s["start"], s["start"] + s["windows"]) for s in segs]
                )
                a = run_hashes(hashes, window)[place]
                b = run_hashes(mixed(hashes), window, _TURN)[place]
                n = len(place)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, ord_)),
                        pa.array(np.full(n, text_key)),
                        pa.array(place),
                        pa.array(a.view(np.int64)),
                        pa.array(b.view(np.int64)),
                    ],
                    ["ord", "text_key", "start", "a", "b"],
                )

    windows = texts.where(F.exists("segments", lambda s: s["hot"])).mapInArrow(
        cut, "ord long, text_key long, start long, a long, b long"
    )
    first = (
        windows.groupBy("a", "b")
        .agg(F.min("ord").alias("least"), F.max("ord").alias("most"))
        .where("least < most")
    )
    return (
        windows.join(first, ["a", "b"])
        .where("ord > least")
        .select("ord", "text_key", "start", (F.col("start") + 1).alias("stop"))
    )


def kept_words(texts: DataFrame, window: int) -> DataFrame:
    """Of each row: n_removed, sha256 of the kept words, and the removed spans."""

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, found in text_slices(batches, "text"):
            removed, digests, spans = [], [], []
            for text, ranges in zip(found, rows.column("ranges").to_pylist()):
                words = text.encode().split()
                change = np.zeros(len(words) + 1, np.int64)
                for r in ranges:
                    change[r["start"]] += 1
                    change[r["stop"] + window - 1] -= 1
                gone = np.cumsum(change)[:-1] > 0
                edges = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]]))).tolist()
                digest = hashlib.sha256(b" ".join([w for w, x in zip(words, gone.tolist()) if not x]))
                removed.append(int(gone.sum()))
                digests.append(digest.hexdigest())
                spans.append(
                    [{"start": a, "stop": b} for a, b in zip(edges[::2], edges[1::2])]
                )
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("ord"),
                    rows.column("text_key"),
                    pa.array(removed, pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(
                        spans,
                        pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])),
                    ),
                ],
                ["ord", "text_key", "n_removed", "kept_sha256", "spans"],
            )

    return texts.mapInArrow(
        keep,
        "ord long, text_key long, n_removed long, kept_sha256 string, "
        "spans array<struct<start: long, stop: long>>",
    )


def order_of(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(LAST))


def repeated_passages(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
    run: int = RUN,
) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256, spans of removed words."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    docs = small_batches(docs).select(
        order_of(F.col(id_column)).alias("ord"), F.xxhash64(text).alias("text_key"), text.alias("text")
    )
    row = ["ord", "text_key"]
    rows = written(scanned(docs, window, run), "scanned-documents")
    found = shared(rows)
    segment = F.struct("start", "windows", "key", "least", "hot")
    candidates = found.groupBy(*row).agg(F.collect_list(segment).alias("segments"))
    texts = written(docs.join(candidates, row), "documents-with-shared-keys")
    ranges = (
        found.where("ord > least AND NOT hot")
        .select(*row, "start", (F.col("start") + F.col("windows")).alias("stop"))
        .unionByName(indexed(first_segments(texts, window), window))
        .unionByName(hot_ranges(texts, window))
        .groupBy(*row)
        .agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))
    )
    changed = kept_words(texts.select(*row, "text").join(ranges, row), window).dropDuplicates(row)
    return rows.select(*row, "n_words", "words_sha256").join(changed, row, "left").select(
        F.when(F.col("ord") < LAST, F.col("ord")).alias("doc_id"),
        "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("kept_sha256", "words_sha256").alias("kept_sha256"),
        "spans",
    )
