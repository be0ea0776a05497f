"""What forests and boosting share: binned vectors, draws by hash, routing, histograms.

A mail's weight of a term falls into a geometric bin, ``floor(log(weight) / log(RATIO))``.
A split sends mails whose bin of a term is at least ``edge`` to the right, and those
without the term to a side that the split names.  Trees are rows of nodes; a node's
number is a hash of its parent's and its side, so a path of any depth is one integer.

Everything random (bootstrap weights, sampled rows, terms that a node may split on) is a
hash of what it is drawn for, so it depends neither on partitions nor on what else is
grown, and a smaller forest is a part of a larger one.

Only the cells that mails have are ever looked at: a node's mails without a term are its
total less those with it.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailspark.config import SPAM, FeatureConfig
from mailspark.operators.blocks import Blocks, cells_of, number_order, term_blocks, vector_rows, with_lists
from mailspark.sources.scratch import written

#: How much wider each bin of weights is than the one below.
RATIO = 1.25
ABSENT = -(1 << 15)
ROOT, DONE = 1, 0
LEAF = -1
#: Cells of a part on average; results don't depend on it.
CELLS_PER_PART = 1_000_000

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_FIRST, _SECOND = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """64 well mixed bits of 64-bit integers."""
    return mixed_in_place(np.atleast_1d(x).astype(np.uint64))


def mixed_in_place(x: np.ndarray) -> np.ndarray:
    """``mixed`` of an array that is the caller's own."""
    x += _GOLDEN
    for shift, factor in ((30, _FIRST), (27, _SECOND)):
        x ^= x >> np.uint64(shift)
        x *= factor
    x ^= x >> np.uint64(31)
    return x


def seed_of(*numbers: int) -> np.uint64:
    """One seed from several numbers."""
    seed = np.uint64(0)
    for number in numbers:
        seed = mixed(seed ^ np.uint64(number))[0]
    return seed


def draws(seeds: np.uint64 | np.ndarray, items: np.ndarray) -> np.ndarray:
    """A number from 0 to 1 for each item, by hash of its seed and itself."""
    return (mixed(np.atleast_1d(items).astype(np.uint64) ^ seeds) >> np.uint64(11)) * 2.0**-53


def children(nodes: np.ndarray, right: np.ndarray) -> np.ndarray:
    bits = mixed((nodes.astype(np.uint64) << np.uint64(1)) | right.astype(np.uint64))
    return np.maximum(bits >> np.uint64(1), 2).astype(np.int64)


def binned_vectors(
    docs: DataFrame | Blocks, vocab: DataFrame, views: Iterable[str], config: FeatureConfig
) -> DataFrame:
    """Term documents with ``terms`` replaced by ``indices`` and, per view, ``bins_<view>``.

    ``vocab`` has token, index and ``<view>_idf``; a cell of a term that a view does not
    keep has the bin ``ABSENT`` there.  ``mail`` is a hash of the id.
    """
    views, blocks = list(views), term_blocks(docs)
    kept = blocks.kept if isinstance(docs, Blocks) else [c for c in docs.columns if c != "terms"]

    def work(mails: pa.Table, terms: pa.Table) -> pa.Table:
        x = cells_of(mails, terms, config)
        numbers = terms.column("index").to_numpy()
        cells = number_order(x, numbers)
        columns = {"indices": numbers[x.row[cells]]}
        for view in views:
            weights = x.tf[cells] * x.column(f"{view}_idf")[x.row[cells]]
            columns[f"bins_{view}"] = weight_bins(weights, x.group[cells], len(x.groups), config)
        return with_lists(x, cells, kept, columns)

    lists = {"indices": "array<int>", **{f"bins_{v}": "array<int>" for v in views}}
    table = vocab.select("token", "index", *[f"{v}_idf" for v in views])
    return vector_rows(blocks, kept, table, work, lists).select(
        *kept, F.xxhash64("id").alias("mail"), *lists
    )


def weight_bins(weights: np.ndarray, groups: np.ndarray, count: int, config: FeatureConfig) -> np.ndarray:
    """Bins of the cells' weights over the lengths of their groups' vectors, ``ABSENT`` where
    a weight is not a number."""
    lengths = np.ones(count)
    if config.l2_norm:
        lengths = np.sqrt(np.bincount(groups, np.nan_to_num(weights) ** 2, count))
    bins = np.full(len(weights), ABSENT, np.int32)
    known = np.flatnonzero(~np.isnan(weights))
    bins[known] = np.floor(np.log(weights[known] / lengths[groups[known]]) / math.log(RATIO))
    return bins


def parts_of(vectors: DataFrame, fewest: int) -> int:
    cells = vectors.agg(F.sum(F.size("indices"))).first()[0] or 0
    return max(fewest, math.ceil(cells / CELLS_PER_PART))


@dataclass(frozen=True)
class Binned:
    """The cells of some mails in one view, row by row with rising terms."""

    rows: np.ndarray
    terms: np.ndarray
    bins: np.ndarray
    count: int

    @property
    def width(self) -> int:
        return int(self.terms.max(initial=0)) + 1

    def keys(self) -> np.ndarray:
        return self.rows * self.width + self.terms

    def lookup(self, keys: np.ndarray, rows: np.ndarray, terms: np.ndarray) -> np.ndarray:
        """Bins of terms in rows, given ``keys()``."""
        found = np.full(len(rows), ABSENT, np.int64)
        inside = np.flatnonzero(terms < self.width)
        if len(keys) and len(inside):
            wanted = rows[inside] * self.width + terms[inside]
            place = np.searchsorted(keys, wanted)
            place[place == len(keys)] = 0
            hit = keys[place] == wanted
            found[inside[hit]] = self.bins[place[hit]]
        return found


def binned(mails: pa.Table, view: str) -> Binned:
    """A view's cells of rows with indices and bins."""
    lists = mails.column("indices")
    rows = np.repeat(np.arange(len(mails)), pc.list_value_length(lists).to_numpy())

    def flat(column: pa.ChunkedArray) -> np.ndarray:
        parts = [c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]
        return np.concatenate([np.zeros(0, np.int64), *parts]).astype(np.int64)

    terms, bins = flat(lists), flat(mails.column(f"bins_{view}"))
    kept = np.flatnonzero(bins != ABSENT)
    return Binned(rows[kept], terms[kept], bins[kept], len(mails))


def spam(mails: pa.Table) -> np.ndarray:
    return (mails.column("label").to_numpy() == SPAM).astype(np.int64)


def goes_right(bins: np.ndarray, edges: np.ndarray, absent_right: np.ndarray) -> np.ndarray:
    return np.where(bins == ABSENT, absent_right, bins >= edges)


@dataclass(frozen=True)
class Tree:
    """Nodes sorted by number; ``terms`` is ``LEAF`` for leaves, whose values count."""

    nodes: np.ndarray
    terms: np.ndarray
    edges: np.ndarray
    absent_right: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple]) -> "Tree":
        """From rows (node, term, edge, absent_right, value)."""
        node, term, edge, right, value = zip(*sorted(rows))
        return cls(
            np.array(node, np.int64),
            np.array(term, np.int64),
            np.array(edge, np.int64),
            np.array(right, bool),
            np.array(value, np.float64),
        )

    def step(self, x: Binned, keys: np.ndarray, rows: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where nodes of rows lead, and which of them moved."""
        place = np.minimum(np.searchsorted(self.nodes, nodes), len(self.nodes) - 1)
        moves = (self.nodes[place] == nodes) & (self.terms[place] != LEAF)
        new, m = nodes.copy(), np.flatnonzero(moves)
        bins = x.lookup(keys, rows[m], self.terms[place[m]])
        right = goes_right(bins, self.edges[place[m]], self.absent_right[place[m]])
        new[m] = children(nodes[m], right)
        return new, moves

    def route(self, x: Binned, keys: np.ndarray) -> np.ndarray:
        """The node each row ends in."""
        rows, nodes = np.arange(x.count), np.full(x.count, ROOT, np.int64)
        left = rows
        while len(left):
            new, moves = self.step(x, keys, left, nodes[left])
            nodes[left] = new
            left = left[moves]
        return nodes

    def predict(self, x: Binned, keys: np.ndarray) -> np.ndarray:
        return self.values[np.searchsorted(self.nodes, self.route(x, keys))]


def histogram(
    groups: np.ndarray, terms: np.ndarray, bins: np.ndarray, amounts: list[np.ndarray]
) -> tuple[np.ndarray, ...]:
    """Sums of amounts by (group, term, bin): groups, terms, bins, sums…"""
    if not len(groups):
        none = np.zeros(0, np.int64)
        return (none,) * (3 + len(amounts))
    low, width = int(bins.min()), int(bins.max()) - int(bins.min()) + 1
    span = int(terms.max()) + 1
    keys = (groups * span + terms) * width + (bins - low)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sums = [np.add.reduceat(a[order], first) for a in amounts]
    keys = keys[first]
    rest, found = np.divmod(keys, width)
    return (rest // span, rest % span, found + low, *sums)


# --- trees as tables ------------------------------------------------------------

NODE_COLUMNS = ("tree", "node", "term", "edge", "absent_right", "value")
#: Nodes that go to the tasks at a time when mails are scored.
NODES_AT_ONCE = 500_000


def node_blocks(nodes: DataFrame) -> list[tuple[int, int]]:
    """Runs of trees (first, last) with about ``NODES_AT_ONCE`` nodes, or one larger tree."""
    sizes = nodes.groupBy("tree").agg(F.count("*").alias("n")).orderBy("tree").collect()  # one a tree
    blocks, start, total = [], None, 0
    for row in sizes:
        if start is not None and total + row["n"] > NODES_AT_ONCE:
            blocks.append((start, last))
            start, total = None, 0
        start = row["tree"] if start is None else start
        total, last = total + row["n"], row["tree"]
    return blocks + ([(start, last)] if start is not None else [])


def tree_sums(docs: DataFrame | Blocks, vocab: DataFrame, nodes: DataFrame, config: FeatureConfig) -> DataFrame:
    """Term documents with ``tree_sum``, the sum of the values of the leaves they end in.

    The vectors are written once and read again for every block of trees, whose nodes go
    to the tasks; a block has a bounded size, however many trees there are.
    """
    view = "final"
    table = vocab.withColumnRenamed("idf", f"{view}_idf")
    vectors = written(binned_vectors(docs, table, [view], config), "binned-mails")
    kept = docs.kept if isinstance(docs, Blocks) else [c for c in docs.columns if c != "terms"]
    sums = None
    for first, last in node_blocks(nodes):
        rows: dict[int, list[tuple]] = {}
        block = nodes.where(F.col("tree").between(first, last)).select(*NODE_COLUMNS)
        for tree, *node in block.toLocalIterator():
            rows.setdefault(tree, []).append(tuple(node))
        part = vectors.mapInArrow(
            _summer([Tree.of(r) for _, r in sorted(rows.items())], view),
            "id string, tree_sum double",
        )
        sums = part if sums is None else sums.unionByName(part)
    if sums is None:
        return vectors.select(*kept, F.lit(0.0).alias("tree_sum"))
    sums = sums.groupBy("id").agg(F.sum("tree_sum").alias("tree_sum"))
    return vectors.select(*kept).join(sums, "id")


def _summer(trees: list[Tree], view: str):
    def run(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            mails = pa.Table.from_batches([batch])
            x = binned(mails, view)
            keys = x.keys()
            sums = np.zeros(x.count)
            for tree in trees:
                sums += tree.predict(x, keys)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sums)], ["id", "tree_sum"])

    return run
