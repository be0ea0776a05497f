"""Random forests grown level by level, and the search of their whole grid.

All trees of all runs (a view of the training mails and a number of terms per split) grow
together.  A pass over the mails moves them to the nodes that the last splits made, and
sums spam and all mails of the nodes that are open, by (tree, node, term, bin) over the
non-zero cells of the terms drawn for the node.  Spark adds the sums up and keeps the best
split of each node.  Splits are a table, and a part of the mails gets those of its nodes.

A mail counts in a tree as often as a Poisson draw with mean 1 says.  A node draws each term
with the probability that gives the wanted number on average; if none of them can split
it, it draws ``WIDER`` times as many and takes the first in the order of their draws that
can, until all terms were tried.  Draws are hashes of tree, node and term.

Hence smaller grid points are parts of the largest: fewer trees are the first ones, a
lower depth or a larger node to split cuts a tree off earlier.  Held-out mails ride along,
and each takes the vote of a point's leaf when it passes the node where that point stops,
so one growth evaluates every point.

Rows: ids are unique; repeated mails each count; mails without a known term go left;
of equal gains the smallest term and bin wins.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mailspark.config import SEED
from mailspark.operators.linear import spread_partitions
from mailspark.operators.trees import (
    ABSENT,
    DONE,
    LEAF,
    ROOT,
    Binned,
    binned,
    children,
    draws,
    histogram,
    mixed,
    mixed_in_place,
    parts_of,
    seed_of,
    spam,
)
from mailspark.sources.scratch import written

#: How many times as many terms a node draws when none of those it drew can split it.
WIDER = 8
RETRY = -2
NO_LIMIT = 1 << 30
#: Cells whose draws are looked at at a time.
CELLS_AT_ONCE = 1 << 15
FEWEST_PARTS = 16
STATE, VOTES, DECISION, SUMS, TOTAL = range(5)
#: What a part is told of each node it has mails in.
TOLD = (
    "node", "term", "edge", "g", "h", "n", "right_g", "right_h", "right_n", "depth", "before", "tries",
)

#: Probabilities that a Poisson draw with mean 1 is at most 0, 1, 2, …
_POISSON = np.cumsum([0.36787944117144233 / f for f in (1, 1, 2, 6, 24, 120, 720, 5040, 40320)])


@dataclass(frozen=True)
class Run:
    """Which mails a forest is grown on, and the share of the terms that a node draws."""

    view: str
    fold: int | None
    share: float


@dataclass(frozen=True)
class Cut:
    """Where a grid point stops: its depth and the fewest mails of a node to split."""

    depth: int
    least: int


@dataclass(frozen=True)
class Forest:
    """``nodes`` has run, tree, node, depth, term, edge, absent_right, value (the share of
    spam), mails, gain; ``votes`` has per held-out mail the mean votes by (run, cut, trees)."""

    nodes: DataFrame
    votes: DataFrame | None
    passes: int


@dataclass(frozen=True)
class Growth:
    """How forests grow: ``cuts`` and ``sizes`` (numbers of trees) are the points to judge."""

    runs: tuple[Run, ...]
    trees: int
    depth: int = NO_LIMIT
    least: int = 2
    cuts: tuple[Cut, ...] = ()
    sizes: tuple[int, ...] = ()
    bootstrap: bool = True

    def tree_seed(self, tree: int) -> np.uint64:
        return seed_of(SEED, 2, tree)

    def weights(self, tree: int, ids: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """How often each mail counts in a tree."""
        if not self.bootstrap:
            return inside.astype(np.int64)
        found = np.searchsorted(_POISSON, draws(seed_of(SEED, 3, tree), ids), "right")
        return np.where(inside, found, 0)


def poisson_share(share: float, tries: np.ndarray) -> np.ndarray:
    return np.minimum(1.0, share * float(WIDER) ** tries)


class TreeState:
    """Where the mails of a part are in one tree, and what is known of the open nodes."""

    def __init__(self, nodes: np.ndarray, count: int):
        self.nodes = nodes
        self.depth = np.zeros(count, np.int64)
        self.before = np.full(count, NO_LIMIT)
        self.tries = np.zeros(count, np.int64)
        self.closed = np.zeros(count, bool)

    def advance(self, growth: Growth, decided: dict[str, np.ndarray], x: Binned, keys: np.ndarray) -> np.ndarray:
        """Move the mails as decided; the decision of each mail's last node, or -1."""
        order = np.argsort(decided["node"])
        decided = {k: v[order] for k, v in decided.items()}
        rows = np.flatnonzero(self.nodes != DONE)
        taken = np.full(len(self.nodes), -1)
        if not len(order) or not len(rows):
            return taken
        at = np.searchsorted(decided["node"], self.nodes[rows])
        term = decided["term"][at]
        taken[rows] = order[at]
        self.depth[rows], self.before[rows] = decided["depth"][at], decided["before"][at]
        self.tries[rows] = np.where(term == RETRY, decided["tries"][at] + 1, 0)
        self.nodes[rows[term == LEAF]] = DONE
        moving, here = rows[term >= 0], at[term >= 0]
        bins = x.lookup(keys, moving, decided["term"][here])
        right = (bins != ABSENT) & (bins >= decided["edge"][here])
        self.nodes[moving] = children(self.nodes[moving], right)
        self.depth[moving] += 1
        self.before[moving] = decided["n"][here]
        g, h, n = (
            np.where(right, decided[f"right_{c}"][here], decided[c][here] - decided[f"right_{c}"][here])
            for c in "ghn"
        )
        self.closed[moving] = (g == 0) | (g == h) | (n < growth.least) | (self.depth[moving] >= growth.depth)
        return taken


def open_sums(
    state: TreeState, growth: Growth, tree: int, share: float, x: Binned, labels: np.ndarray, weights: np.ndarray
) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    """Totals of the nodes that hold mails, and sums over the drawn cells of the open ones."""
    rows = np.flatnonzero(state.nodes != DONE)
    nodes, first, group = np.unique(state.nodes[rows], return_index=True, return_inverse=True)
    w, counted = weights[rows], (weights[rows] > 0).astype(np.int64)

    def total(amounts: np.ndarray) -> np.ndarray:
        return np.bincount(group, amounts, len(nodes)).astype(np.int64)

    totals = {
        "node": nodes, "g": total(w * labels[rows]), "h": total(w), "n": total(counted),
        "depth": state.depth[rows][first], "before": state.before[rows][first],
        "tries": state.tries[rows][first],
    }
    group_of = np.full(x.count, -1)
    summed = (w > 0) & ~state.closed[rows]
    group_of[rows[summed]] = group[summed]
    # A node that draws again looks at the terms it has not tried yet.
    upto = poisson_share(share, totals["tries"])
    above = np.where(totals["tries"] > 0, poisson_share(share, totals["tries"] - 1), 0.0)
    cells, groups, drawn = drawn_cells(x, group_of, draws_seed(growth.tree_seed(tree), nodes), above, upto)
    tries = totals["tries"][groups]
    mails = x.rows[cells]
    amounts = [(weights * labels)[mails], weights[mails], np.ones(len(mails), np.int64)]
    order = np.where(tries > 0, np.rint(drawn * 2.0**52), 0).astype(np.int64)
    groups, terms, bins, g, h, n, sums = histogram(groups, x.terms[cells], x.bins[cells], [*amounts, order])
    order = sums // np.maximum(n, 1)  # the same for all cells of a node's term
    return totals, {"node": nodes[groups], "term": terms, "bin": bins, "order": order, "g": g, "h": h, "n": n}


def drawn_cells(
    x: Binned, group_of: np.ndarray, seeds: np.ndarray, above: np.ndarray, upto: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The cells of grouped mails whose draw is in their group's span, their groups and draws.

    Cells are looked at by ``CELLS_AT_ONCE``, which stay in a processor's cache.
    """
    terms = x.terms.astype(np.uint64, copy=False)
    low, high = (np.ceil(share * 2.0**53).astype(np.uint64) for share in (above, upto))
    found = []
    for start in range(0, len(terms) if len(seeds) else 0, CELLS_AT_ONCE):
        group = group_of[x.rows[start : start + CELLS_AT_ONCE]]
        inside = np.flatnonzero(group >= 0)
        if not len(inside):
            continue
        group = group[inside]
        bits = mixed_in_place(terms[start + inside] ^ seeds[group])
        bits >>= np.uint64(11)
        kept = bits < high[group]
        if low.any():
            kept &= bits >= low[group]
        kept = np.flatnonzero(kept)
        found.append((start + inside[kept], group[kept], bits[kept] * 2.0**-53))
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(parts) for parts in zip(none, *found))


def draws_seed(seed: np.uint64, nodes: np.ndarray) -> np.ndarray:
    return mixed(nodes.astype(np.uint64) ^ seed)


SCHEMA = (
    "part int, kind int, tree int, node long, term long, bin int, order long, "
    "g long, h long, n long, depth int, before long, tries int, blob binary"
)
_TYPES = {
    "part": pa.int32(), "kind": pa.int32(), "tree": pa.int32(), "node": pa.int64(), "term": pa.int64(),
    "bin": pa.int32(), "order": pa.int64(), "g": pa.int64(), "h": pa.int64(), "n": pa.int64(),
    "depth": pa.int32(), "before": pa.int64(), "tries": pa.int32(), "blob": pa.binary(),
}


def passer(growth: Growth, first_pass: bool):
    """The work of one part in a pass: its mails and what was sent to them."""
    variants, sizes = growth.cuts, np.array(growth.sizes, np.int64)

    def run_pass(key, mails: pa.Table, sent: pa.Table) -> pa.Table:
        part = key[0].as_py()
        if not len(mails):
            return _table(part, [])
        mails = mails.sort_by("mail").combine_chunks()
        labels, ids = spam(mails), mails.column("mail").to_numpy().view(np.uint64)
        folds = mails.column("fold").to_numpy(zero_copy_only=False)
        kinds = sent.column("kind").to_numpy() if len(sent) else np.zeros(0, np.int32)
        trees = sent.column("tree").to_numpy() if len(sent) else np.zeros(0, np.int32)
        blobs = sent.column("blob")
        states = {trees[i]: blobs[int(i)].as_py() for i in np.flatnonzero(kinds == STATE)}
        votes = {trees[i]: blobs[int(i)].as_py() for i in np.flatnonzero(kinds == VOTES)}
        decided = _by_tree(sent.take(pa.array(np.flatnonzero(kinds == DECISION))))
        out: list[dict] = []
        for r, run in enumerate(growth.runs):
            x = binned(mails, run.view)
            keys = x.keys()
            inside = np.ones(len(labels), bool) if run.fold is None else folds != run.fold
            shape = (len(labels), len(variants), len(sizes))
            seen = np.frombuffer(votes[r], np.float32).reshape(shape).copy() if r in votes else np.zeros(shape, np.float32)
            for t in range(growth.trees):
                tree = r * growth.trees + t
                if not first_pass and tree not in states:
                    continue
                start = np.full(len(labels), ROOT) if first_pass else np.frombuffer(states[tree], np.int64).copy()
                state = TreeState(start, len(labels))
                if not first_pass:
                    taken = state.advance(growth, decided[tree], x, keys)
                    if len(variants):
                        _vote(seen, taken, decided[tree], variants, t < sizes)
                if not (state.nodes != DONE).any():
                    continue
                weights = growth.weights(t, ids, inside)
                totals, sums = open_sums(state, growth, t, run.share, x, labels, weights)
                out.append({"kind": STATE, "tree": tree, "blob": [state.nodes.tobytes()]})
                out.append({"kind": TOTAL, "tree": tree, **totals})
                if len(sums["node"]):
                    out.append({"kind": SUMS, "tree": tree, **sums})
            if len(variants):
                out.append({"kind": VOTES, "tree": r, "blob": [seen.tobytes()]})
        return _table(part, out)

    return run_pass


def _by_tree(told: pa.Table) -> dict[int, dict[str, np.ndarray]]:
    """The decisions of each tree, as arrays."""
    if not len(told):
        return {}
    trees = told.column("tree").to_numpy()
    order = np.argsort(trees, kind="stable")
    columns = {c: told.column(c).to_numpy()[order] for c in TOLD}
    found, first = np.unique(trees[order], return_index=True)
    ends = np.append(first[1:], len(order))
    return {t: {c: v[a:b] for c, v in columns.items()} for t, a, b in zip(found, first, ends)}


def _vote(seen: np.ndarray, taken: np.ndarray, decided: dict, cuts: Sequence[Cut], sizes: np.ndarray) -> None:
    """Add the votes of the points that stop at the node a mail has just left or ended in."""
    rows = np.flatnonzero(taken >= 0)
    at = taken[rows]
    term, depth, n, before = (decided[c][at] for c in ("term", "depth", "n", "before"))
    share = decided["g"][at] / np.maximum(decided["h"][at], 1)
    for v, cut in enumerate(cuts):
        stops = (term == LEAF) | (depth == cut.depth) | (n < cut.least)
        stops &= (term != RETRY) & (depth <= cut.depth) & (before >= cut.least)
        seen[rows[stops], v] += (share[stops, None] * sizes).astype(np.float32)


def _table(part: int, out: list[dict]) -> pa.Table:
    columns: dict[str, list] = {name: [] for name in _TYPES}
    for rows in out:
        count = len(rows["blob"] if "blob" in rows else rows["node"])
        for name, kind in _TYPES.items():
            value = part if name == "part" else rows.get(name)
            if name == "blob":
                columns[name].append(pa.array(value or [None] * count, kind))
            else:
                filled = np.full(count, value) if value is None or np.isscalar(value) else value
                columns[name].append(pa.nulls(count, kind) if value is None else pa.array(filled).cast(kind))
    return pa.table(
        {name: pa.chunked_array(c, type=_TYPES[name]) for name, c in columns.items()}
    )


def decisions(out: DataFrame, growth: Growth) -> DataFrame:
    """What becomes of every open node: a split, a leaf, or another draw of terms.

    Sums are dealt by term too, so a node with many terms, such as the root, is no hot group.
    """
    totals = written(
        out.where(F.col("kind") == TOTAL)
        .groupBy("tree", "node")
        .agg(
            *[F.sum(c).alias(c) for c in "ghn"],
            *[F.any_value(c).alias(c) for c in ("depth", "before", "tries")],
        ),
        "forest-totals",
    )
    above = (
        Window.partitionBy("tree", "node", "term")
        .orderBy(F.desc("bin"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    scanned = (
        out.where(F.col("kind") == SUMS)
        .select("tree", "node", "term", "bin", "order", "g", "h", "n")
        .repartition("tree", "node", "term")
        .groupBy("tree", "node", "term", "bin")
        .agg(F.any_value("order").alias("order"), *[F.sum(c).alias(c) for c in "ghn"])
        .select(
            "tree", "node", "term", "bin", "order", *[F.sum(c).over(above).alias(f"right_{c}") for c in "ghn"]
        )
    )
    left = {c: F.col(c) - F.col(f"right_{c}") for c in "ghn"}
    gain = (
        left["g"] * left["g"] / left["h"]
        + F.col("right_g") * F.col("right_g") / F.col("right_h")
        - F.col("g") * F.col("g") / F.col("h")
    )
    split = F.struct(
        (-F.col("order")).alias("first"), gain.alias("gain"), (-F.col("term")).alias("less_term"),
        (-F.col("bin")).alias("less_bin"), "right_g", "right_h", "right_n",
    )
    best = (
        scanned.join(totals, ["tree", "node"])
        .where((left["h"] > 0) & (F.col("right_h") > 0))
        .groupBy("tree", "node")
        .agg(F.max(split).alias("split"))
    )
    run = F.floor(F.col("tree") / growth.trees).cast("int")
    share = F.element_at(F.array(*[F.lit(r.share) for r in growth.runs]), run + 1)
    drawn_all = share * F.pow(F.lit(float(WIDER)), F.col("tries")) >= 1.0
    ended = (
        (F.col("g") == 0) | (F.col("g") == F.col("h")) | (F.col("n") < growth.least) | (F.col("depth") >= growth.depth)
    )
    term = (
        F.when(ended, F.lit(LEAF))
        .when(F.col("split").isNotNull(), -F.col("split.less_term"))
        .when(drawn_all, F.lit(LEAF))
        .otherwise(F.lit(RETRY))
    )
    return totals.join(best, ["tree", "node"], "left").select(
        "tree", "node", term.cast("long").alias("term"),
        F.coalesce(-F.col("split.less_bin"), F.lit(0)).alias("edge"),
        "g", "h", "n",
        *[F.coalesce(f"split.right_{c}", F.lit(0)).alias(f"right_{c}") for c in "ghn"],
        "depth", "before", "tries",
        F.col("split.gain").alias("gain"),
    )


def grow(vectors: DataFrame, growth: Growth) -> Forest:
    """Grow all runs on binned vectors (id, label, fold, mail, indices, ``bins_<view>``)."""
    parts = parts_of(vectors, FEWEST_PARTS)
    part = F.pmod(F.col("mail"), F.lit(parts)).cast("int")
    cached = vectors.withColumn("part", part).repartition(spread_partitions(vectors.sparkSession, parts), "part").persist()
    kinds = {c: "long" for c in TOLD} | {"part": "int", "kind": "int", "tree": "int", "blob": "binary"}
    sent_columns = ["part", "kind", "tree", *TOLD, "blob"]
    spark = vectors.sparkSession
    sent = spark.createDataFrame([], ", ".join(f"{c} {kinds[c]}" for c in sent_columns))
    levels, passes = [], 0
    try:
        while True:
            passes += 1
            out = written(
                cached.groupBy("part").cogroup(sent.groupBy("part")).applyInArrow(passer(growth, passes == 1), SCHEMA),
                "forest-pass",
            )
            found = written(decisions(out, growth), "forest-decisions")
            if not found.head(1):
                break
            levels.append(found.where(F.col("term") != RETRY))
            here = out.where(F.col("kind") == TOTAL).select("part", "tree", "node")
            told_here = here.join(found, ["tree", "node"]).withColumn("kind", F.lit(DECISION))
            kept = out.where(F.col("kind").isin(STATE, VOTES))
            sent = told_here.select(
                *[F.col(c).cast(kinds[c]).alias(c) for c in sent_columns[:-1]],
                F.lit(None).cast("binary").alias("blob"),
            ).unionByName(
                kept.select("part", "kind", "tree", *[F.lit(None).cast("long").alias(c) for c in TOLD], "blob")
            )
        votes = _votes(cached, out, growth) if growth.cuts else None
    finally:
        cached.unpersist()
    nodes = reduce(DataFrame.unionByName, levels).select(
        F.floor(F.col("tree") / growth.trees).cast("int").alias("run"),
        (F.col("tree") % growth.trees).alias("tree"),
        "node", "depth", "term", F.col("edge").cast("int").alias("edge"),
        F.lit(False).alias("absent_right"),
        F.coalesce(F.try_divide("g", "h"), F.lit(0.0)).cast("double").alias("value"),
        F.col("n").alias("mails"), "gain",
    )
    return Forest(nodes, votes, passes)


def _votes(cached: DataFrame, out: DataFrame, growth: Growth) -> DataFrame:
    """id, label, run, cut, trees, vote: the mean votes for the held-out mails of each run."""
    runs, cuts, sizes = growth.runs, growth.cuts, growth.sizes

    def unpack(key, mails: pa.Table, sent: pa.Table) -> pa.Table:
        mails = mails.sort_by("mail").combine_chunks()
        folds = mails.column("fold").to_numpy(zero_copy_only=False)
        parts = []
        for tree, blob in zip(sent.column("tree").to_pylist(), sent.column("blob").to_pylist()):
            held = np.flatnonzero(folds == runs[tree].fold)
            shape = (len(mails), len(cuts), len(sizes))
            seen = np.frombuffer(blob, np.float32).reshape(shape)[held] / np.array(sizes, np.float32)
            points = len(cuts) * len(sizes)
            some = pa.array(np.repeat(held, points))
            numbers = np.tile(np.arange(points), len(held))
            parts.append(
                pa.table(
                    {
                        "id": mails.column("id").take(some),
                        "label": mails.column("label").take(some).cast(pa.int32()),
                        "run": pa.array(np.full(len(some), tree, np.int32)),
                        "cut": pa.array((numbers // len(sizes)).astype(np.int32)),
                        "trees": pa.array(np.array(sizes, np.int32)[numbers % len(sizes)]),
                        "vote": pa.array(seen.ravel().astype(np.float64)),
                    }
                )
            )
        return pa.concat_tables(parts) if parts else VOTE_ARROW.empty_table()

    return cached.groupBy("part").cogroup(
        out.where(F.col("kind") == VOTES).select("part", "tree", "blob").groupBy("part")
    ).applyInArrow(unpack, "id string, label int, run int, cut int, trees int, vote double")


VOTE_ARROW = pa.schema(
    [("id", pa.string()), ("label", pa.int32()), ("run", pa.int32()), ("cut", pa.int32()),
     ("trees", pa.int32()), ("vote", pa.float64())]
)
