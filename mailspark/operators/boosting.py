"""Second-order boosted trees from histograms of gradients and Hessians.

Many *runs* (a view of the training mails and a grid point) advance together: every level
of the next tree of all runs is one job.  The mails of a part are one row of arrays, its cells
in order of term and bin, so a job sorts nothing.  It sums gradient and Hessian of the log
loss by (run, node, term, bin) over non-zero cells; these sums are dealt by term, an array for
each share of the terms, added up, and the bins of every term are scanned for the best split
of each node.  Splits are few (nodes of the trees that grow just now), so they come to the
driver and go out with the next job; vectors and margins stay where they are.  The first
level's job also brings the sums of the roots and the losses.

A split's mails without the term go to the side where the gain is larger.  A leaf's value
is ``-G / (H + PENALTY)`` times the learning rate.  Rows and columns of a tree are drawn by
hash of the round and of the mail or the term, the same for all runs.

Margins are a column of the parts, brought up to date after ``STAGE`` trees and written
then, so tasks replay few trees.  Held-out mails ride along: at the
rounds asked for their counts are taken, so a shorter run is a prefix of a longer one.

Gradients are summed as integers of ``2**-SCALE_BITS``, so results do not depend on parts.

Rows: ids are unique; mails without a known term follow the defaults; repeated mails each
count; a run of a view without both labels still fits (leaves of one sign).
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailspark.config import SEED
from mailspark.operators.trees import (
    ABSENT,
    LEAF,
    ROOT,
    Tree,
    binned,
    children,
    draws,
    parts_of,
    seed_of,
    spam,
)
from mailspark.sources.scratch import written

PENALTY = 1.0
LEAST_HESSIAN = 1.0
LEAST_GAIN = 1e-6
SCALE_BITS = 30
#: Trees of all runs together that tasks replay, before the margins are updated.
STAGE = 500
LOSS_DIGITS = 12
#: Jobs are many and short, so few mails are in few parts.
FEWEST_PARTS = 12


@dataclass(frozen=True)
class Run:
    """What one booster is fitted on and how; ``fold`` is held out, if any."""

    view: str
    fold: int | None
    depth: int
    rate: float
    row_share: float = 1.0
    column_share: float = 1.0


@dataclass
class Growing:
    """The trees of a run: those since the margins were updated, and the next one's nodes
    as rows (node, term, edge, absent_right, value)."""

    recent: list[Tree] = field(default_factory=list)
    nodes: list[tuple] = field(default_factory=list)


@dataclass(frozen=True)
class Boosted:
    """All runs' nodes (run, tree, node, term, edge, absent_right, value), the mean loss of
    each run before each round and after the last, the gain of each round's first split,
    and counts of held-out mails by (run, rounds)."""

    nodes: list[tuple]
    losses: dict[int, list[float]]
    gains: dict[int, list[float]]
    counts: dict[tuple[int, int], tuple[int, int, int]]

    def tree_rows(self, run: int, rounds: int) -> list[tuple]:
        return [row[1:] for row in self.nodes if row[0] == run and row[1] < rounds]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


class TermCells:
    """The cells of a part's mails in a view, in order of share, term, bin and mail.

    A term's share is the one of ``shares`` groups of terms whose sums are added up together.
    """

    def __init__(self, rows: np.ndarray, terms: np.ndarray, bins: np.ndarray, count: int, shares: int):
        self.rows, self.terms, self.bins, self.count, self.shares = rows, terms, bins, count, shares
        new = np.concatenate([[True], terms[1:] != terms[:-1]]) if len(terms) else np.zeros(0, bool)
        self.starts = np.append(np.flatnonzero(new), len(terms))
        distinct = terms[self.starts[:-1]]
        # Terms in the order of the cells, as one rising number.
        self.span = int(terms.max(initial=0)) + 1
        self.distinct, self.keys = distinct, (distinct % shares).astype(np.int64) * self.span + distinct
        self.drawn: dict[tuple[int, float], np.ndarray] = {}

    def of_term(self, term: int) -> slice:
        """The cells of a term."""
        key = term % self.shares * self.span + term
        at = int(np.searchsorted(self.keys, key)) if term < self.span else len(self.keys)
        if at == len(self.keys) or self.keys[at] != key:
            return slice(0, 0)
        return slice(self.starts[at], self.starts[at + 1])

    def of_round(self, round_: int, share: float) -> np.ndarray:
        """Whether the round drew the cells' terms."""
        if (round_, share) not in self.drawn:
            drawn = column_drawn(self.distinct, round_, share)
            self.drawn[round_, share] = np.repeat(drawn, np.diff(self.starts))
        return self.drawn[round_, share]

    def ends(self, tree: Tree) -> np.ndarray:
        """The place among the tree's nodes that each mail ends in."""
        known = {node: i for i, node in enumerate(tree.nodes.tolist())}
        sides = [children(tree.nodes, np.full(len(tree.nodes), right)).tolist() for right in (False, True)]
        found = np.full(self.count, known[ROOT])
        waiting = [(known[ROOT], np.arange(self.count))]
        while waiting:
            i, here = waiting.pop()
            if tree.terms[i] == LEAF or not len(here):
                continue
            right = np.full(self.count, tree.absent_right[i])
            cells = self.of_term(int(tree.terms[i]))
            right[self.rows[cells]] = self.bins[cells] >= tree.edges[i]
            for side, of_side in zip(sides, (~right[here], right[here])):
                child, moved = known[side[i]], here[of_side]
                found[moved] = child
                waiting.append((child, moved))
        return found


class Part:
    """Some mails with the margins, gradients and drawn rows of a run, from a packed row."""

    def __init__(self, row: dict, shares: int):
        self.row, self.shares = row, shares
        self.labels, self.folds, self.ids = (
            np.frombuffer(row[c], t) for c, t in (("labels", np.int8), ("folds", np.int32), ("ids", np.uint64))
        )
        self.margins = np.frombuffer(row["margins"], np.float64).reshape(len(self.labels), -1)
        self.views: dict[str, TermCells] = {}

    def cells(self, view: str) -> TermCells:
        if view not in self.views:
            arrays = (np.frombuffer(self.row[f"{c}_{view}"], t) for c, t in PACKED.items())
            self.views[view] = TermCells(*arrays, len(self.labels), self.shares)
        return self.views[view]

    def current(self, number: int, run: Run, growing: Growing) -> np.ndarray:
        found = self.margins[:, number].copy()
        for tree in growing.recent:
            found += tree.values[self.cells(run.view).ends(tree)]
        return found

    def trained(self, run: Run) -> np.ndarray:
        return np.ones(len(self.labels), bool) if run.fold is None else self.folds != run.fold


#: The arrays of a part's cells in a view.
PACKED = {"rows": np.int32, "terms": np.int32, "bins": np.int16}


def packed_columns(views: Sequence[str]) -> list[str]:
    return ["labels", "folds", "ids", "margins", *[f"{c}_{v}" for v in views for c in PACKED]]


def packer(views: Sequence[str], runs: int, shares: int):
    """The mails of a partition as one row of arrays."""
    names = packed_columns(views)

    def work(batches: Iterable[pa.RecordBatch]):
        mails = _whole(batches)
        if mails is None:
            return
        folds = pc.fill_null(mails.column("fold"), -1).to_numpy().astype(np.int32)
        arrays = [spam(mails).astype(np.int8), folds, mails.column("mail").to_numpy()]
        arrays.append(np.zeros(len(mails) * runs))
        for view in views:
            x = binned(mails, view)
            order = np.lexsort((x.rows, x.bins, x.terms, x.terms % shares))
            arrays += [c[order].astype(t) for c, t in zip((x.rows, x.terms, x.bins), PACKED.values())]
        yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in arrays], names)

    return work


def _parts(batches: Iterable[pa.RecordBatch], shares: int) -> Iterable[Part]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Part({n: batch.column(n)[i].as_buffer() for n in batch.schema.names}, shares)


def row_drawn(ids: np.ndarray, round_: int, share: float) -> np.ndarray:
    return draws(seed_of(SEED, 0, round_), ids) < share


def column_drawn(terms: np.ndarray, round_: int, share: float) -> np.ndarray:
    return draws(seed_of(SEED, 1, round_), terms) < share


def _whole(batches: Iterable[pa.RecordBatch]) -> pa.Table | None:
    """A partition's rows; its size is bounded by the number of partitions."""
    found = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(found) if found else None


def gradients(part: Part, run: Run, margins: np.ndarray, round_: int):
    """Gradient and Hessian as integers, and the rows drawn for the round."""
    p = _sigmoid(margins)
    scale = float(1 << SCALE_BITS)
    g = np.rint((p - part.labels) * scale).astype(np.int64)
    h = np.rint(p * (1.0 - p) * scale).astype(np.int64)
    used = part.trained(run)
    if run.row_share < 1.0:
        used = used & row_drawn(part.ids, round_, run.row_share)
    return g, h, np.flatnonzero(used)


#: Sums as they leave a part: a row of arrays for each share of the terms.  ``heads`` has (run,
#: node, rows) and ``roots``, before the first level, (run, g, h, mails), with the runs' losses.
SUMS = {
    "heads": np.int64, "terms": np.int32, "bins": np.int16, "g": np.int64, "h": np.int64,
    "roots": np.int64, "losses": np.float64,
}


def level_sums(
    runs: Sequence[Run], growing: Sequence[Growing], open_nodes: dict[int, list[int]], round_: int, keys: Sequence[int],
    with_roots: bool,
):
    """Histograms of the open nodes of all runs over the cells of a part, dealt by term.

    ``keys`` has a key for each share of the terms.
    """

    def work(batches: Iterable[pa.RecordBatch]):
        for part in _parts(batches, len(keys)):
            roots, losses = [], []
            out: list[dict[str, list]] = [{c: [] for c in SUMS} for _ in keys]
            for r, run in enumerate(runs):
                if r not in open_nodes and not with_roots:
                    continue
                margins = part.current(r, run, growing[r])
                g, h, used = gradients(part, run, margins, round_)
                if with_roots:
                    inside = part.trained(run)
                    loss = np.logaddexp(0.0, np.where(part.labels == 1, -margins, margins))[inside].sum()
                    roots.append((r, int(g[used].sum()), int(h[used].sum()), int(inside.sum())))
                    losses.append(float(loss))
                if r in open_nodes:
                    x = part.cells(run.view)
                    at = np.full(x.count, ROOT, np.int64)
                    if growing[r].nodes:
                        tree = Tree.of(growing[r].nodes)
                        at = tree.nodes[x.ends(tree)]
                    _add_sums(out, r, run, x, g, h, used, at, open_nodes[r], round_)
            rows = {"key": pa.array(keys, pa.int32())}
            for name, kind in SUMS.items():
                if name in ("roots", "losses"):
                    shared = np.array(roots if name == "roots" else losses, kind).tobytes()
                    values = [shared] * len(keys)
                else:
                    none = np.zeros(0, kind)
                    values = [np.concatenate([none, *o[name]]).astype(kind, copy=False).tobytes() for o in out]
                rows[name] = pa.array(values, pa.binary())
            yield pa.RecordBatch.from_pydict(rows)

    return work


def _add_sums(out, r: int, run: Run, x: TermCells, g, h, used, at, nodes: list[int], round_: int) -> None:
    """Add the sums of a run's open nodes by term and bin to those of each share of the terms."""
    wanted = np.sort(np.array(nodes, np.int64))
    place = np.minimum(np.searchsorted(wanted, at), len(wanted) - 1)
    group = np.full(x.count, -1)
    inside = used[wanted[place[used]] == at[used]]
    group[inside] = place[inside]
    of_cells = group[x.rows]
    if run.column_share < 1.0:
        of_cells = np.where(x.of_round(round_, run.column_share), of_cells, -1)
    for n, node in enumerate(wanted.tolist()):
        cells = np.flatnonzero(of_cells == n)
        if not len(cells):
            continue
        terms, bins, rows = x.terms[cells], x.bins[cells], x.rows[cells]
        first = np.flatnonzero(np.concatenate([[True], (terms[1:] != terms[:-1]) | (bins[1:] != bins[:-1])]))
        sums = [np.add.reduceat(c[rows], first) for c in (g, h)]
        terms, bins = terms[first], bins[first]
        ends = np.searchsorted(terms % x.shares, np.arange(x.shares + 1))
        for share, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
            if a < b:
                found = [np.array([r, node, b - a], np.int64), terms[a:b], bins[a:b], *(c[a:b] for c in sums)]
                for name, values in zip(SUMS, found):
                    out[share][name].append(values)


def share_keys(spark: SparkSession, shares: int) -> list[int]:
    """A key for each share of the terms, each of which goes to a partition of its own."""
    some = shares * (math.ceil(math.log(shares + 1)) + 20)
    place = F.pmod(F.hash(F.col("id").cast("int")), F.lit(shares))
    found = spark.range(some).groupBy(place.alias("place")).agg(F.min("id").alias("key"))
    keys = [row["key"] for row in found.collect()]  # one for each share
    free = iter(range(some, some + shares))
    return sorted(keys) + [next(free) for _ in range(shares - len(keys))]


SPLIT_ARROW = pa.schema(
    [("run", pa.int32()), ("node", pa.int64()), ("gain", pa.float64()), ("less_term", pa.int64()),
     ("absent_left", pa.bool_()), ("edge", pa.int32()), ("right_g", pa.int64()), ("right_h", pa.int64()),
     ("loss", pa.float64()), ("mails", pa.int64())]
)
SPLIT_ROWS = (
    "run int, node long, gain double, less_term long, absent_left boolean, edge int, right_g long, right_h long, "
    "loss double, mails long"
)


def scanner(totals: dict[tuple[int, int], tuple[int, int]], first_key: int):
    """The best split of each (run, node) among the terms of a partition.

    A partition has all sums of its terms; ``totals`` has (g, h) of the open nodes.  Before the
    first level the parts' sums of the roots are added up, and the partition of ``first_key``
    hands them on with the losses and numbers of mails, as rows without a gain.
    """

    def work(batches: Iterable[pa.RecordBatch]):
        sums = _whole(batches)
        if sums is None:
            return
        keys = sums.column("key").to_numpy()

        def joined(name: str, of: np.ndarray) -> np.ndarray:
            column = sums.column(name)
            parts = [np.frombuffer(column[int(i)].as_buffer(), SUMS[name]) for i in of]
            return np.concatenate([np.zeros(0, SUMS[name]), *parts])

        one = np.flatnonzero(keys == (first_key if first_key in keys else keys[0]))
        roots, losses = joined("roots", one).reshape(-1, 4), joined("losses", one)
        known_totals = dict(totals)
        if len(roots):
            all_roots = []
            for r in np.unique(roots[:, 0]).tolist():
                of_run = roots[:, 0] == r
                g, h, mails = (int(n) for n in roots[of_run, 1:].sum(axis=0))
                known_totals[r, ROOT] = (g, h)
                all_roots.append((r, ROOT, None, None, None, None, g, h, math.fsum(losses[of_run].tolist()), mails))
            if first_key in keys:
                columns = zip(zip(*all_roots), SPLIT_ARROW.types)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], schema=SPLIT_ARROW)
        every = np.arange(len(keys))
        heads = joined("heads", every).reshape(-1, 3)
        if not len(heads):
            return
        term, bins, g, h = (joined(c, every) for c in ("terms", "bins", "g", "h"))
        pairs = sorted({(r, n) for r, n in heads[:, :2].tolist()})
        number = {pair: i for i, pair in enumerate(pairs)}
        pair = np.repeat(np.array([number[r, n] for r, n in heads[:, :2].tolist()], np.int64), heads[:, 2])
        term, bins = term.astype(np.int64), bins.astype(np.int64)
        most, width = int(bins.max()), int(bins.max() - bins.min()) + 1
        order_key = (pair * (int(term.max()) + 1) + term) * width + (most - bins)
        order = np.argsort(order_key, kind="stable")
        order_key, pair, term, bins, g, h = (c[order] for c in (order_key, pair, term, bins, g, h))
        first = np.flatnonzero(np.concatenate([[True], order_key[1:] != order_key[:-1]]))
        g, h = np.add.reduceat(g, first), np.add.reduceat(h, first)
        pair, term, bins, of_term = pair[first], term[first], bins[first], order_key[first] // width
        run, node = (np.array([p[i] for p in pairs], np.int64)[pair] for i in (0, 1))
        begins = np.flatnonzero(np.concatenate([[True], of_term[1:] != of_term[:-1]]))
        sizes = np.diff(np.append(begins, len(g)))

        def scanned(amounts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Of each bin and those above, and of all bins of the term."""
            running = np.cumsum(amounts)
            before = np.repeat(running[begins] - amounts[begins], sizes)
            return running - before, np.repeat(np.add.reduceat(amounts, begins), sizes)

        (up_g, in_g), (up_h, in_h) = scanned(g), scanned(h)
        known = np.array([known_totals[p] for p in pairs])
        all_g, all_h = (known[pair, i] for i in (0, 1))
        unit = float(1 << SCALE_BITS)

        def value(g: np.ndarray, h: np.ndarray) -> np.ndarray:
            return (g / unit) ** 2 / (h / unit + PENALTY)

        # Mails without the term on the left, then on the right.
        right_g = np.concatenate([up_g, all_g - in_g + up_g])
        right_h = np.concatenate([up_h, all_h - in_h + up_h])
        all_g, all_h = np.tile(all_g, 2), np.tile(all_h, 2)
        gain = value(all_g - right_g, all_h - right_h) + value(right_g, right_h) - value(all_g, all_h)
        least = int(LEAST_HESSIAN * unit)
        enough = (right_h >= least) & (all_h - right_h >= least) & (gain > LEAST_GAIN)
        rows = np.flatnonzero(enough)
        if not len(rows):
            return
        at, absent_left = rows % len(run), rows < len(run)
        order = np.lexsort((bins[at], absent_left, -term[at], gain[rows], node[at], run[at]))
        rows, at, absent_left = rows[order], at[order], absent_left[order]
        last = np.flatnonzero(
            np.concatenate([(run[at][1:] != run[at][:-1]) | (node[at][1:] != node[at][:-1]), [True]])
        )
        rows, at, absent_left = rows[last], at[last], absent_left[last]
        found = (run[at], node[at], gain[rows], -term[at], absent_left, bins[at], right_g[rows], right_h[rows])
        columns = [pa.array(c).cast(t) for c, t in zip(found, SPLIT_ARROW.types)]
        columns += [pa.nulls(len(at), t) for t in SPLIT_ARROW.types[len(columns) :]]
        yield pa.RecordBatch.from_arrays(columns, schema=SPLIT_ARROW)

    return work


def best_splits(
    sums: DataFrame, keys: Sequence[int], known: dict[tuple[int, int], tuple[int, int]]
) -> tuple[dict[tuple[int, int], dict], list[dict]]:
    """Of every (run, node) the split with the largest gain, if any has enough, and the roots' sums.

    ``known`` has (g, h) of the open nodes, but the roots.  Of equal gains the smallest term
    wins, then absent mails on the left, then the largest edge.
    """
    rows = sums.repartition(len(keys), "key").mapInArrow(scanner(known, keys[0]), SPLIT_ROWS)
    best: dict[tuple[int, int], dict] = {}
    roots: list[dict] = []
    order = ("gain", "less_term", "absent_left", "edge")
    for row in rows.collect():  # at most one per open node and partition, and one per run
        key, split = (row["run"], row["node"]), row.asDict()
        if split["gain"] is None:
            roots.append(split)
        elif key not in best or [split[c] for c in order] > [best[key][c] for c in order]:
            best[key] = split
    return best, roots


def boost(
    vectors: DataFrame, runs: Sequence[Run], rounds: int, counted: Sequence[int] = ()
) -> Boosted:
    """Fit all runs on binned vectors (id, label, fold, mail, indices, ``bins_<view>``).

    ``counted`` are the numbers of rounds after which held-out mails are counted.
    """
    runs, spark = tuple(runs), vectors.sparkSession
    parts = parts_of(vectors, FEWEST_PARTS)
    keys = share_keys(spark, parts)
    views = list(dict.fromkeys(run.view for run in runs))
    schema = ", ".join(f"{c} binary" for c in packed_columns(views))
    vectors = vectors.select("id", "label", "fold", "mail", "indices", *[f"bins_{v}" for v in views])
    cached = vectors.repartition(parts, "id").mapInArrow(packer(views, len(runs), parts), schema).persist()
    growing = [Growing() for _ in runs]
    nodes: list[tuple] = []
    losses: dict[int, list[float]] = {r: [] for r in range(len(runs))}
    gains: dict[int, list[float]] = {r: [] for r in range(len(runs))}
    counts: dict[tuple[int, int], tuple[int, int, int]] = {}

    def splits_of(open_nodes: dict[int, list[int]], round_: int, known: dict, with_roots: bool):
        sums = cached.mapInArrow(
            level_sums(runs, growing, open_nodes, round_, keys, with_roots),
            ", ".join(["key int", *[f"{c} binary" for c in SUMS]]),
        )
        return best_splits(sums, keys, known)

    def take_roots(roots: list[dict]) -> dict[tuple[int, int], tuple[int, int, int]]:
        """(run, node) -> (g, h, depth) of the roots; also notes the mean losses."""
        for row in roots:
            losses[row["run"]].append(round(row["loss"] / max(1, row["mails"]), LOSS_DIGITS))
        return {(row["run"], ROOT): (row["right_g"], row["right_h"], 0) for row in roots}

    try:
        for round_ in range(rounds):
            open_nodes = {r: [ROOT] for r, run in enumerate(runs) if run.depth > 0}
            found, roots = splits_of(open_nodes, round_, {}, True)
            totals = take_roots(roots)
            level = 0
            while True:
                for (r, node), split in found.items():
                    _split(growing[r], totals, r, node, split, level)
                    if node == ROOT:
                        gains[r].append(split["gain"])
                level += 1
                open_nodes = {}
                for (r, node), (g, h, depth) in totals.items():
                    if depth == level < runs[r].depth and h >= 2 * LEAST_HESSIAN * (1 << SCALE_BITS):
                        open_nodes.setdefault(r, []).append(node)
                if not open_nodes:
                    break
                known = {(r, n): totals[r, n][:2] for r, ns in open_nodes.items() for n in ns}
                found, _ = splits_of(open_nodes, round_, known, False)
            for r, run in enumerate(runs):
                _finish(growing[r], totals, r, run, round_, nodes)
            done = round_ + 1
            waiting = sum(len(g.recent) for g in growing)
            if waiting >= STAGE and done < rounds or done in counted:
                staged = written(cached.mapInArrow(_updater(runs, growing, parts), schema), "staged-margins")
                cached.unpersist()
                cached = staged.persist()
                for g in growing:
                    g.recent = []
                if done in counted:
                    counts.update(_counts(cached, runs, done, parts))
        take_roots(splits_of({}, rounds, {}, True)[1])
    finally:
        cached.unpersist()
    return Boosted(nodes, losses, gains, counts)


def _split(growing: Growing, totals: dict, r: int, node: int, split: dict, level: int) -> None:
    g, h, _ = totals[r, node]
    left, right = children(np.array([node, node]), np.array([False, True])).tolist()
    growing.nodes.append((node, -split["less_term"], split["edge"], not split["absent_left"], 0.0))
    totals[r, left] = (g - split["right_g"], h - split["right_h"], level + 1)
    totals[r, right] = (split["right_g"], split["right_h"], level + 1)
    known = {n[0] for n in growing.nodes}
    growing.nodes += [(c, LEAF, ABSENT, False, 0.0) for c in (left, right) if c not in known]
    growing.nodes = [n for n in growing.nodes if n[:2] != (node, LEAF)]


def _finish(growing: Growing, totals: dict, r: int, run: Run, round_: int, nodes: list[tuple]) -> None:
    """Give the leaves their values, and close the tree."""
    unit = float(1 << SCALE_BITS)

    def value(node: int) -> float:
        g, h, _ = totals.get((r, node), (0, 0, 0))
        return -run.rate * (g / unit) / (h / unit + PENALTY)

    rows = growing.nodes or [(ROOT, LEAF, ABSENT, False, 0.0)]
    rows = [(*n[:4], value(n[0]) if n[1] == LEAF else 0.0) for n in rows]
    nodes += [(r, round_, *row) for row in rows]
    growing.recent.append(Tree.of(rows))
    growing.nodes = []


def _updater(runs: Sequence[Run], growing: Sequence[Growing], shares: int):
    def work(batches: Iterable[pa.RecordBatch]):
        for part in _parts(batches, shares):
            found = np.stack([part.current(r, run, growing[r]) for r, run in enumerate(runs)], axis=1)
            row = {**part.row, "margins": found.tobytes()}
            yield pa.RecordBatch.from_arrays([pa.array([bytes(v)], pa.binary()) for v in row.values()], list(row))

    return work


def _counter(runs: Sequence[Run], shares: int):
    """By run the true positives, false positives and false negatives of a part's held-out mails."""

    def work(batches: Iterable[pa.RecordBatch]):
        for part in _parts(batches, shares):
            rows = []
            for r, run in enumerate(runs):
                if run.fold is not None:
                    held, found, is_spam = part.folds == run.fold, part.margins[:, r] > 0, part.labels == 1
                    hits = (found & is_spam, found & ~is_spam, ~found & is_spam)
                    rows.append((r, *(int((held & h).sum()) for h in hits)))
            columns = zip(*rows)
            yield pa.RecordBatch.from_pydict({n: pa.array(c, pa.int64()) for n, c in zip(("run", "tp", "fp", "fn"), columns)})

    return work


def _counts(cached: DataFrame, runs: Sequence[Run], rounds: int, shares: int) -> dict[tuple[int, int], tuple[int, int, int]]:
    """True positives, false positives and false negatives of the held-out mails."""
    if all(run.fold is None for run in runs):
        return {}
    found = cached.mapInArrow(_counter(runs, shares), "run long, tp long, fp long, fn long")
    rows = found.groupBy("run").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")]).collect()  # one per run
    return {(row["run"], rounds): (row["tp"], row["fp"], row["fn"]) for row in rows}


def mean_f1(boosted: Boosted, runs: Sequence[Run], rounds: int) -> dict[Run, float]:
    """Mean F1 over the folds of the runs that differ in nothing else, keyed without a fold."""
    scores: dict[Run, list[float]] = {}
    for r, run in enumerate(runs):
        if run.fold is not None:
            tp, fp, fn = boosted.counts[r, rounds]
            key = Run("", None, run.depth, run.rate, run.row_share, run.column_share)
            scores.setdefault(key, []).append(2 * tp / (2 * tp + fp + fn) if tp else 0.0)
    return {key: math.fsum(s) / len(s) for key, s in scores.items()}
