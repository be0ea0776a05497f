"""Ranked lexical search by hashed max-sketches.

A document's *sketch* has ``WIDTH`` coordinates.  Every term is hashed to one of them,
and a coordinate holds the largest impact of the terms that share it.  Looking a query's
terms up in a sketch thus never gives less than the document's score, so it is an upper
bound.  The bounds of many documents and all queries of a block are taken together; then
the documents of a query are scored exactly in descending order of their bounds, until no
bound that is left reaches the query's worst kept score.  The result is exact.

``index`` reads whole texts once and writes per document its terms, their counts and its
sketch.  An impact grows with a term's count and is otherwise the document's own, so the
sketch keeps the largest *counts*; they become impacts when the corpus is known.  Each task
of ``search`` goes through its documents with one list of the best ``k`` per query, which
is all it hands on; these lists are then merged in two steps, so no group grows with the
corpus by more than ``k`` rows per task and salt.

Queries are the stated set: they pass through the driver in blocks of at most
``BLOCK_TERMS`` terms and ``BLOCK_CHARS`` characters (one longer query is a block of its
own), and each block is one pass over the index.

Rows: null, empty and termless texts are in no result and in none of the corpus counts,
queries without a term that occurs get no rows; whole texts are read however long; equal
scores go by ascending id, null ids last; repeated documents and queries are each their
own; an empty table on either side gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mailspark.llm.common import small_batches, text_slices
from mailspark.sources.scratch import written

#: Coordinates of a sketch.
WIDTH = 4096
#: Documents whose bounds are taken together, and query terms looked up in them at a time.
DOCS_AT_ONCE = 256
TERMS_AT_ONCE = 1 << 14
BLOCK_TERMS = 100_000
BLOCK_CHARS = 4_000_000
SALTS = 64
BEST = 20
LAST = (1 << 63) - 1

# The score's constants.
IMPACT = 1_000_000_000
LENGTH_WEIGHT = 25

#: Bytes of terms as they are, A-Z lower-cased, all else as spaces.
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A
    else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80
    else 0x20
    for b in range(256)
)


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


def coordinates(terms: Iterable[bytes], width: int) -> np.ndarray:
    return np.fromiter(map(crc32, terms), np.int64) % width


def lists(values: pa.Array, sizes: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


INDEX_SCHEMA = (
    "doc_id long, n long, terms array<string>, counts array<long>, "
    "places array<int>, maxima array<long>"
)


def index(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = WIDTH
) -> DataFrame:
    """Documents with a term: doc_id, n, terms, counts, and the sketch (places, maxima)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches, "text"):
            found = [Counter(terms_of(t)) for t in texts]
            kept = np.array([i for i, c in enumerate(found) if c], np.int64)
            if not len(kept):
                continue
            found = [found[i] for i in kept]
            sizes = np.array([len(c) for c in found])
            terms = [t for c in found for t in c]
            counts = np.fromiter((n for c in found for n in c.values()), np.int64, len(terms))
            owners = np.repeat(np.arange(len(found)), sizes)
            keys = owners * width + coordinates(terms, width)
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            maxima = np.maximum.reduceat(counts[order], first)
            keys = keys[first]
            places = np.bincount(keys // width, minlength=len(found))
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id").take(pa.array(kept)),
                    pa.array(np.add.reduceat(counts, starts)),
                    lists(pa.array(terms, pa.binary()).cast(pa.string()), sizes),
                    lists(pa.array(counts), sizes),
                    lists(pa.array((keys % width).astype(np.int32)), places),
                    lists(pa.array(maxima), places),
                ],
                ["doc_id", "n", "terms", "counts", "places", "maxima"],
            )

    return small_batches(docs).select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).cast("string").alias("text"),
    ).mapInArrow(run, INDEX_SCHEMA)


@dataclass(frozen=True)
class Corpus:
    """Documents with a term, and all their terms with repeats."""

    documents: int
    terms: int

    def length_factor(self, n: int) -> int:
        """What a document's length adds to the divisor of its impacts (12 times m)."""
        return 12 * (100 - LENGTH_WEIGHT + LENGTH_WEIGHT * n * self.documents // self.terms)

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.documents + 2) / (2 * df + 1)))


def impacts(counts: np.ndarray, length_factors: np.ndarray) -> np.ndarray:
    return IMPACT * counts // (1000 * counts + length_factors)


@dataclass(frozen=True)
class Block:
    """Queries as runs of (term number, weight): those of query i begin at ``starts[i]``."""

    numbers: list[int]
    vocabulary: dict[str, int]
    starts: np.ndarray
    terms: np.ndarray
    weights: np.ndarray
    places: np.ndarray

    def parts(self, most: int) -> list[tuple[int, int]]:
        """Runs of queries with about ``most`` terms, or one longer query."""
        if not len(self.starts):
            return []
        cuts, start = [], 0
        ends = np.append(self.starts[1:], len(self.terms))
        for i, end in enumerate(ends):
            if i > start and end - self.starts[start] > most:
                cuts.append((start, i))
                start = i
        return [*cuts, (start, len(ends))]

    def of(self, query: int) -> slice:
        last = query + 1 == len(self.starts)
        return slice(self.starts[query], len(self.terms) if last else self.starts[query + 1])


def query_blocks(queries: DataFrame) -> Iterator[list[tuple[object, Counter]]]:
    """(item id, counted terms) of the stated queries, some at a time."""
    block, terms, chars = [], 0, 0
    for item, text in queries.toLocalIterator():
        found = Counter(terms_of(text or ""))
        size = sum(map(len, found))
        if block and (terms + len(found) > BLOCK_TERMS or chars + size > BLOCK_CHARS):
            yield block
            block, terms, chars = [], 0, 0
        block.append((item, found))
        terms, chars = terms + len(found), chars + size
    if block:
        yield block


def weighted(
    spark: SparkSession, indexed: DataFrame, block: list[tuple[object, Counter]], corpus: Corpus,
    width: int,
) -> Block:
    """The block's terms that occur in a document, with the weights these give them."""
    every = sorted({t for _, counts in block for t in counts})
    rows = spark.createDataFrame([(t.decode("utf-8", "replace"),) for t in every], "term string")
    if sum(map(len, every)) <= BLOCK_CHARS and len(every) <= BLOCK_TERMS:
        rows = F.broadcast(rows)
    held = (
        indexed.select(F.explode("terms").alias("term"))
        .join(rows, "term")
        .groupBy("term")
        .agg(F.count("*").alias("df"))
    )
    frequencies = {r["term"]: r["df"] for r in held.toLocalIterator()}
    vocabulary = {t: i for i, t in enumerate(sorted(frequencies))}
    numbers, starts, terms, weights, names = [], [], [], [], []
    for number, (_, counts) in enumerate(block):
        known = [(t.decode("utf-8", "replace"), c) for t, c in counts.items()]
        known = [(t, c) for t, c in known if t in vocabulary]
        if known:
            numbers.append(number)
            starts.append(len(terms))
            terms.extend(vocabulary[t] for t, _ in known)
            weights.extend(c * corpus.weight(frequencies[t]) for t, c in known)
            names.extend(t.encode() for t, _ in known)
    return Block(
        numbers,
        vocabulary,
        np.array(starts, np.int64),
        np.array(terms, np.int64),
        np.array(weights, np.int64),
        coordinates(names, width),
    )


def bounds(block: Block, sketches: np.ndarray, first: int, last: int) -> np.ndarray:
    """Upper bounds (query, document) of some queries from sketches (coordinate, document)."""
    begin = block.starts[first]
    end = len(block.terms) if last == len(block.starts) else block.starts[last]
    looked_up = sketches[block.places[begin:end]] * block.weights[begin:end, None]
    return np.add.reduceat(looked_up, block.starts[first:last] - begin, axis=0)


class Best:
    """The best ``k`` documents of a query: highest score first, then smallest id."""

    def __init__(self, k: int):
        self.k, self.heap = k, []

    def takes(self, score: int, order: int) -> bool:
        return score > 0 and (len(self.heap) < self.k or (score, -order) > self.heap[0])

    def put(self, score: int, order: int) -> None:
        if self.takes(score, order):
            push = heapq.heappush if len(self.heap) < self.k else heapq.heapreplace
            push(self.heap, (score, -order))

    @property
    def least(self) -> int:
        """A bound below this changes nothing any more."""
        return self.heap[0][0] if len(self.heap) == self.k else 1


def rescore(
    block: Block,
    query: int,
    upper: np.ndarray,
    orders: list[int],
    exact: Callable[[int, int], int],
    best: Best,
) -> int:
    """Score documents exactly by descending bound, until none left can be kept."""
    candidates = np.flatnonzero(upper >= best.least)
    scored = 0
    for d in candidates[np.argsort(-upper[candidates], kind="stable")]:
        bound = int(upper[d])
        if bound < best.least:
            break
        if best.takes(bound, orders[d]):
            best.put(exact(query, d), orders[d])
            scored += 1
    return scored


def ranker(block: Block, corpus: Corpus, k: int, width: int):
    """The step that turns rows of the index into the best documents of each query."""
    parts = block.parts(TERMS_AT_ONCE)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in block.numbers]
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS_AT_ONCE):
                some(batch.slice(at, DOCS_AT_ONCE), best)
        rows = [
            (block.numbers[q], None if order == -LAST else -order, score)
            for q, found in enumerate(best)
            for score, order in found.heap
        ]
        if rows:
            numbers, ids, scores = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int64()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())],
                ["query", "doc_id", "score"],
            )

    def some(batch: pa.RecordBatch, best: list[Best]) -> None:
        orders = [LAST if i is None else i for i in batch.column("doc_id").to_pylist()]
        lengths = np.array([corpus.length_factor(n) for n in batch.column("n").to_pylist()])
        places, maxima = batch.column("places"), batch.column("maxima")
        owners = np.repeat(np.arange(len(orders)), places.value_lengths().to_numpy())
        sketches = np.zeros((width, len(orders)), np.int64)
        sketches[places.flatten().to_numpy(), owners] = impacts(
            maxima.flatten().to_numpy(), lengths[owners]
        )
        known: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def exact(query: int, d: int) -> int:
            if d not in known:
                known[d] = term_impacts(batch, int(d), lengths[d])
            numbers, values = known[d]
            if not len(numbers):
                return 0
            run = block.of(query)
            place = np.searchsorted(numbers, block.terms[run])
            place[place == len(numbers)] = 0
            hit = numbers[place] == block.terms[run]
            return int((block.weights[run] * values[place] * hit).sum())

        for first, last in parts:
            upper = bounds(block, sketches, first, last)
            least = np.array([best[q].least for q in range(first, last)])
            for q in np.flatnonzero((upper >= least[:, None]).any(axis=1)):
                rescore(block, first + q, upper[q], orders, exact, best[first + q])

    def term_impacts(batch: pa.RecordBatch, d: int, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and impacts of the document's terms that any query has."""
        terms = batch.column("terms")[d].as_py()
        counts = batch.column("counts")[d].values.to_numpy()
        numbers = np.array([block.vocabulary.get(t, -1) for t in terms], np.int64)
        there = np.flatnonzero(numbers >= 0)
        there = there[np.argsort(numbers[there])]
        return numbers[there], impacts(counts[there], length)

    return run


def first_rows(rows: DataFrame, k: int) -> DataFrame:
    """The best ``k`` rows of each query with their rank, merged in two steps."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    place = F.row_number().over(Window.partitionBy("query", "salt").orderBy(*order))
    salted = salted.withColumn("place", place).where(F.col("place") <= k).drop("place", "salt")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(*order))
    return salted.withColumn("rank", rank).where(F.col("rank") <= k)


def search(
    indexed: DataFrame,
    queries: DataFrame,
    k: int = BEST,
    item_column: str = "item_id",
    text_column: str = "text",
    width: int = WIDTH,
) -> DataFrame:
    """item_id, rank, doc_id, score: each query's ``k`` best documents of a written index.

    ``width`` is that of the index.  Queries in several blocks are answered one block after
    the other, each written.
    """
    spark = indexed.sparkSession
    n, total = indexed.agg(F.count("*"), F.sum("n")).first()
    corpus = Corpus(n, total or 0)
    stated = queries.select(
        F.col(item_column).alias("item_id"), F.col(text_column).cast("string").alias("text")
    )
    kind = stated.schema["item_id"].dataType.simpleString()
    narrow = indexed.select("doc_id", "n", "terms", "counts", "places", "maxima")

    def answers(block: list[tuple[object, Counter]]) -> DataFrame:
        prepared = weighted(spark, indexed, block, corpus, width)
        found = narrow.mapInArrow(
            ranker(prepared, corpus, k, width), "query long, doc_id long, score long"
        )
        # At most BLOCK_TERMS queries, so one row each.
        items = spark.createDataFrame(
            [(i, item) for i, (item, _) in enumerate(block)], f"query long, item_id {kind}"
        )
        return first_rows(found, k).join(items, "query").select(
            "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"
        )

    blocks = query_blocks(stated)
    block, following = next(blocks, []), next(blocks, None)
    if following is None:
        return answers(block)
    done = [written(answers(block), "search-block")]
    while following is not None:
        done.append(written(answers(following), "search-block"))
        following = next(blocks, None)
    return reduce(DataFrame.unionByName, done)


def rank_documents(docs: DataFrame, queries: DataFrame, k: int = BEST) -> DataFrame:
    """Index documents (doc_id, text) and answer queries (item_id, text)."""
    return search(written(index(docs), "search-index"), queries, k)
