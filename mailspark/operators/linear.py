"""Linear classifiers for a whole search at once, with weights as a table.

A *point* is a loss, a cost and an intercept; a *view* is a set of training mails (all of
them, or all but one fold).  Every point is fitted on every view in the same passes: a
pass reads the vectors once and improves all fits that have not converged yet.

Problem.  With margins ``m = y * (x . w + s * w0)`` of mails x and labels y in -1, 1, a fit
minimises ``|w|^2 / 2 + w0^2 / 2 + cost * sum(loss(m))``.  The intercept ``s * w0`` is
penalised like a weight for ``s = 1`` and practically free for a large ``s``.

Method.  Vectors that fit one part (``MAILS_PER_PART``, ``CELLS_PER_PART``) are solved there, a
task for each view, by truncated Newton steps on the dual variables' problem, which takes one
pass.  All others are left to ``subspace``, which spreads the cells over many tasks.

Stop.  Primal and dual values of a fit are sums over mails and weights, and their
difference bounds its distance from the optimum.  A fit ends when that gap is at most
``TOLERANCE`` of the loss at zero weights, and is left out of further passes.

Rows: ids are unique; mails without a known term count through the intercept alone;
repeated mails each count; a view without both labels raises.  Vectors hold term numbers
and scaled counts once; the weight of a term in a view, zero or its idf there, comes with
the terms, so leaving a fold out costs one column and no vectors of its own.
"""

from __future__ import annotations

import math
import warnings
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailspark.config import HAM, SPAM, FeatureConfig
from mailspark.operators.blocks import Blocks, block_sums, cells_of, number_order, term_blocks, vector_rows, with_lists
from mailspark.operators.features import kept_df, smooth_idf
from mailspark.operators.metrics import f1_score
from mailspark.operators.naive_bayes import FINAL, SCORE_DIGITS, check_folds, view_members
from mailspark.operators.objective import (
    INTERCEPT,
    LOGISTIC,
    MOST_PASSES,
    SQUARED_HINGE,
    TOLERANCE,
    Point,
    dual_values,
    losses,
)
from mailspark.operators.subspace import solve as subspace_solve
from mailspark.operators.vectors import checked_size, with_index
from mailspark.sources.scratch import written

#: What is solved in one part, whose vectors are arrays of one task for each view.
CELLS_PER_PART = 300_000
MAILS_PER_PART = 50_000
#: Cells, and mails, that a part works on at a time.
CELLS_AT_ONCE, MAILS_AT_ONCE = 1_000_000, 1_000
#: The share of the tolerated gap that a part leaves in its own problem, and the most steps.
LOCAL_SHARE = 0.1
LOCAL_STEPS, CG_STEPS = 50, 300
#: At most so many partitions for each unit, so that few units don't share one.
SPREAD = 4
MANY_UNITS = 1000
WEIGHT, DUAL, SUMS = 0, 1, 2


class Cells:
    """The non-zero cells of some mails' vectors, mail by mail; ``signs`` are -1 and 1.

    They are kept once and worked on in pieces, so what comes beside them is bounded.
    """

    def __init__(self, starts: np.ndarray, columns: np.ndarray, values: np.ndarray, width: int, signs: np.ndarray):
        self.columns, self.values = columns.astype(np.int32, copy=False), values
        self.width, self.signs, self.starts = width, signs, starts
        self.sizes = np.diff(starts)

    def pieces(self) -> Iterator[tuple[slice, slice]]:
        """Runs of mails and their cells, ``CELLS_AT_ONCE`` or those of one mail at most."""
        first, count = 0, len(self.signs)
        while first < count:
            last = int(np.searchsorted(self.starts, self.starts[first] + CELLS_AT_ONCE, "right")) - 1
            last = min(max(last, first + 1), count)
            yield slice(first, last), slice(self.starts[first], self.starts[last])
            first = last

    def only(self, mails: np.ndarray) -> "Cells":
        """The cells of some mails, in rising order."""
        if len(mails) == len(self.signs):
            return self
        chosen = np.zeros(len(self.signs), bool)
        chosen[mails] = True
        kept = np.repeat(chosen, self.sizes)
        starts = np.concatenate([[0], np.cumsum(self.sizes[mails])])
        return Cells(starts, self.columns[kept], self.values[kept], self.width, self.signs[mails])

    def margins(self, weights: np.ndarray, scale: float) -> np.ndarray:
        """The signed products with weights, whose last entry is the intercept's."""
        sums = np.full(len(self.signs), scale * weights[-1])
        for mails, cells in self.pieces():
            filled = np.flatnonzero(self.sizes[mails])
            if len(filled):
                starts = self.starts[mails][filled] - cells.start
                products = self.values[cells] * weights[self.columns[cells]]
                sums[mails.start + filled] += np.add.reduceat(products, starts)
        return self.signs * sums

    def weighted_sum(self, amounts: np.ndarray, scale: float) -> np.ndarray:
        """The sum of the signed vectors, each times its amount."""
        signed = self.signs * amounts
        sums = np.zeros(self.width + 1)
        for mails, cells in self.pieces():
            products = np.repeat(signed[mails], self.sizes[mails]) * self.values[cells]
            sums[:-1] += np.bincount(self.columns[cells], products, self.width)
        sums[-1] = scale * signed.sum()
        return sums


def local_solution(
    cells: Cells,
    point: Point,
    weights: np.ndarray,
    duals: np.ndarray,
    parts: int,
    start: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, float, float, np.ndarray]:
    """A part's new duals, the change of the weights, its loss and dual value, and v.

    The values are those before the change, or after it if there are no other parts.

    The part's problem is ``|v - centre|^2 / (2 parts) + cost * sum(loss(margins of v))``:
    its optimum gives the duals that are best while the other parts' stay as they are and
    move as far as this part does.  The search begins at ``start``, or at the weights.
    """
    scale = point.intercept_scale
    margins = cells.margins(weights, scale)
    loss, down, _ = losses(point.loss, margins)
    before = float(loss.sum()), float(dual_values(point.loss, duals, point.cost).sum())
    centre = weights - parts * cells.weighted_sum(duals, scale)
    v = weights.copy()
    if start is not None:
        v, margins = start, cells.margins(start, scale)
        down = losses(point.loss, margins)[1]

    def gradient(v: np.ndarray, down: np.ndarray) -> np.ndarray:
        return (v - centre) / parts - point.cost * cells.weighted_sum(down, scale)

    g = gradient(v, down)
    at_zero = point.cost * float(losses(point.loss, np.zeros(1))[0][0]) * len(margins)
    for _ in range(LOCAL_STEPS):
        size = float(np.linalg.norm(g))
        loss, _, curvature = losses(point.loss, margins)
        # The weights that follow from the margins' duals are v - parts * g.  The gap there
        # is that at v, parts * |g|^2 / 2, and what the loss rises on the way.
        rise = point.cost * float(curvature @ cells.margins(g, scale) ** 2)
        if parts * (size * size + parts * rise) / 2 <= LOCAL_SHARE * TOLERANCE * at_zero:
            break
        step, moved = newton_step(cells, point, g, curvature, parts, size)
        v, margins = line_search(point, v, step, margins, moved, centre, parts, loss, g)
        _, down, _ = losses(point.loss, margins)
        g = gradient(v, down)
    new = point.cost * losses(point.loss, margins)[1]
    change = cells.weighted_sum(new - duals, scale)
    if parts > 1:
        return new, change, *before, v
    loss = losses(point.loss, cells.margins(weights + change, scale))[0]
    return new, change, float(loss.sum()), float(dual_values(point.loss, new, point.cost).sum()), v


def newton_step(
    cells: Cells, point: Point, g: np.ndarray, curvature: np.ndarray, parts: int, size: float
) -> tuple[np.ndarray, np.ndarray]:
    """Conjugate gradients on the Newton system; also the margins' change along the step.

    Mails that don't bend the loss are left out.
    """
    scale, bent = point.intercept_scale, cells.only(np.flatnonzero(curvature))
    bend = curvature[curvature > 0]
    step = np.zeros_like(g)
    rest, direction = -g, -g
    square = float(rest @ rest)
    goal = (min(0.1, math.sqrt(size / (1.0 + size))) * size) ** 2
    for _ in range(CG_STEPS):
        along = bent.margins(direction, scale)
        curved = direction / parts + point.cost * bent.weighted_sum(bend * along, scale)
        amount = square / float(direction @ curved)
        step += amount * direction
        rest = rest - amount * curved
        previous, square = square, float(rest @ rest)
        if square <= goal:
            break
        direction = rest + (square / previous) * direction
    return step, cells.margins(step, scale)


def line_search(
    point: Point, v: np.ndarray, step: np.ndarray, margins: np.ndarray, moved: np.ndarray,
    centre: np.ndarray, parts: int, loss: np.ndarray, g: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """The first halved step that lowers the part's objective enough; needs no vectors."""
    off = v - centre
    linear, square = float(off @ step) / parts, float(step @ step) / (2 * parts)
    slope, total, t = float(g @ step), float(loss.sum()), 1.0
    while t > 1e-10:
        new = float(losses(point.loss, margins + t * moved)[0].sum())
        change = t * linear + t * t * square + point.cost * (new - total)
        if change <= 1e-4 * t * slope:
            break
        t /= 2
    return v + t * step, margins + t * moved


# --- tables -------------------------------------------------------------------


def view_sizes(train: Blocks, folds: int | None) -> dict[str, int]:
    """Training mails of each view, which must hold both labels."""
    members = view_members(folds)
    counts = train.mails.agg(
        F.max("fold").alias("last_fold"),
        *[
            F.count_if(member & (F.col("label") == label)).alias(f"{view}_{label}")
            for view, member in members.items()
            for label in (HAM, SPAM)
        ],
    ).first().asDict()
    check_folds(counts.pop("last_fold"), folds)
    for name, n in counts.items():
        if not n:
            raise ValueError(f"no training mails for view_label {name}")
    return {v: counts[f"{v}_{HAM}"] + counts[f"{v}_{SPAM}"] for v in members}


def view_vocabulary(train: Blocks, config: FeatureConfig, sizes: dict[str, int], folds: int | None) -> DataFrame:
    """token, index and the idf of each view; null where a view does not keep the term.

    Frequencies without a fold follow from one aggregate over all mails.
    """

    def idf_of(view: str) -> Column:
        df, n = F.col(f"{view}_df"), F.lit(sizes[view])
        return F.when(kept_df(df, n, config), smooth_idf(df, n)).alias(f"{view}_idf")

    members = view_members(folds)
    frequencies = (
        train.terms.groupBy("token")
        .agg(*[F.sum(F.when(member, F.col("df")).otherwise(0)).alias(f"{view}_df") for view, member in members.items()])
        .select("token", *[idf_of(view) for view in members])
        .where(F.coalesce(*[F.col(f"{view}_idf") for view in members]).isNotNull())
    )
    return written(with_index(written(frequencies, "view-terms")), "view-vocabulary")


def count_vectors(train: Blocks, vocab: DataFrame, config: FeatureConfig) -> DataFrame:
    """id, label, fold, indices, values, mail: the scaled counts of the terms that any view keeps;
    ``mail`` is a number of the row."""
    kept = ["id", "label", "fold"]

    def work(mails: pa.Table, terms: pa.Table) -> pa.Table:
        x = cells_of(mails, terms, config)
        numbers = terms.column("index").to_numpy()
        cells = number_order(x, numbers)
        return with_lists(x, cells, kept, {"indices": numbers[x.row[cells]], "values": x.tf[cells]})

    lists = {"indices": "array<int>", "values": "array<double>"}
    rows = vector_rows(train, kept, vocab.select("token", "index"), work, lists)
    return written(rows.withColumn("mail", F.monotonically_increasing_id()), "count-vectors")


@dataclass(frozen=True)
class LinearSearch:
    """Fits of all points on all views: ``table`` has per token each view's idf and, in
    ``<view>_<point number>``, its weights; ``gaps`` are relative duality gaps."""

    config: FeatureConfig
    points: tuple[Point, ...]
    folds: int | None
    table: DataFrame
    intercepts: dict[tuple[str, int], float]
    gaps: dict[tuple[str, int], float]
    terms: int
    passes: int

    def model_table(self, point: int) -> DataFrame:
        """token, idf, weight of a point fitted on all mails."""
        return self.table.where(F.col(f"{FINAL}_idf").isNotNull()).select(
            "token", F.col(f"{FINAL}_idf").alias("idf"), F.col(f"{FINAL}_{point}").alias("weight")
        )

    def margins(self, docs: DataFrame | Blocks) -> DataFrame:
        """Term documents (id, fold, terms, …) or blocks with ``margin_<point>`` of the view that left
        the mail's fold out, or of all mails where the fold is null."""

        def by_view(of_view) -> Column:
            value = of_view(FINAL)
            for k in range(self.folds or 0):
                value = F.when(F.col("fold") == k, of_view(f"cv{k}")).otherwise(value)
            return value

        names = {f"margin_{i}": i for i in range(len(self.points))}
        weights = {
            name: by_view(lambda view, i=i: F.col(f"{view}_{i}")) for name, i in names.items()
        }
        idf = by_view(lambda view: F.col(f"{view}_idf"))
        sums = block_sums(term_blocks(docs), self.table, idf, weights, self.config)
        for name, i in names.items():
            intercept = by_view(lambda view, i=i: F.lit(self.intercepts[view, i]))
            sums = sums.withColumn(name, F.round(F.col(name) + intercept, SCORE_DIGITS))
        return sums

    def fold_f1(self, train: DataFrame | Blocks) -> list[float]:
        """Mean F1 on spam over the folds of each point, rounded so that equal means tie."""
        spam, counts = F.col("label") == SPAM, []
        for i in range(len(self.points)):
            found = F.col(f"margin_{i}") > 0
            counts += [
                F.count_if(spam & found).alias(f"tp_{i}"),
                F.count_if(~spam & found).alias(f"fp_{i}"),
                F.count_if(spam & ~found).alias(f"fn_{i}"),
            ]
        by_fold = self.margins(train).groupBy("fold").agg(*counts)
        means = by_fold.agg(
            *[
                F.round(F.avg(f1_score(f"tp_{i}", f"fp_{i}", f"fn_{i}")), SCORE_DIGITS).alias(str(i))
                for i in range(len(self.points))
            ]
        )
        return list(means.first())


def search(
    docs: DataFrame | Blocks, config: FeatureConfig, points: Sequence[Point], folds: int | None
) -> LinearSearch:
    """Fit all points on term documents (id, label, fold, terms) or blocks; ``folds`` adds their
    views."""
    points = tuple(points)
    train = term_blocks(docs).train()
    members = view_members(folds)
    views = list(members)
    sizes = view_sizes(train, folds)
    vocab = view_vocabulary(train, config, sizes, folds)
    checked_size(vocab.count())
    vectors = count_vectors(train, vocab, config)
    n, cells = vectors.agg(F.count("*"), F.sum(F.size("indices"))).first()
    if n <= MAILS_PER_PART and (cells or 0) <= CELLS_PER_PART:
        problem = Problem(points, views, 1, config.l2_norm, sizes)
        weights, gaps, passes = problem.solve(vectors, vocab, members)
    else:
        weights, found, passes = subspace_solve(vectors, vocab, points, views, cells or 0, config.l2_norm)
        gaps = {(views[v], i): gap for (v, i), gap in found.items()}

    columns = [
        F.max(F.when(F.col("view") == v, F.col(f"v{i}"))).alias(f"{view}_{i}")
        for v, view in enumerate(views)
        for i in range(len(points))
    ]
    wide = weights.groupBy(F.col("pos").alias("index")).agg(*columns)
    names = [f"{view}_{i}" for view in views for i in range(len(points))]
    table = written(
        vocab.join(wide, "index", "left").select(
            *[c for c in vocab.columns if c != "index"],
            *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in names],
        ),
        "linear-models",
    )
    bias = {r["view"]: r for r in weights.where(F.col("pos") == INTERCEPT).collect()}  # one a view
    intercepts = {
        (view, i): point.intercept_scale * (bias[v][f"v{i}"] if v in bias else 0.0)
        for v, view in enumerate(views)
        for i, point in enumerate(points)
    }
    terms = table.where(F.col(f"{FINAL}_idf").isNotNull()).count()
    return LinearSearch(config, points, folds, table, intercepts, gaps, terms, passes)


def spread_partitions(spark: SparkSession, units: int) -> int:
    """A number of partitions over which units 0, 1, … spread well by their hash."""
    if units > MANY_UNITS:
        return SPREAD * units
    hashes = [r[0] for r in spark.range(units).select(F.hash(F.col("id").cast("int"))).collect()]
    loads = {n: max(Counter(h % n for h in hashes).values()) for n in range(units, SPREAD * units + 8)}
    return min(loads, key=lambda n: (loads[n], n))


@dataclass(frozen=True)
class Problem:
    """The fits of some points on some views over vectors in parts."""

    points: tuple[Point, ...]
    views: list[str]
    parts: int
    l2_norm: bool
    sizes: dict[str, int]

    @property
    def values(self) -> list[str]:
        return [f"v{i}" for i in range(len(self.points))]

    def units(self, vectors: DataFrame, members: dict[str, Column], count: int) -> DataFrame:
        """The mails of each part and view, kept in ``count`` partitions where they are worked on."""
        numbers = [F.when(m, F.lit(v)) for v, m in enumerate(members.values())]
        part = F.pmod(F.xxhash64("id"), F.lit(self.parts)).cast("int")
        return (
            vectors.withColumn("view", F.explode(F.array_compact(F.array(*numbers))))
            .select((part * len(self.views) + F.col("view")).alias("unit"), "id", "label", "indices", "values")
            .repartition(count, "unit")
            .sortWithinPartitions("unit", "id")
            .persist()
        )

    def unit_terms(self, vectors: DataFrame, vocab: DataFrame) -> DataFrame:
        """unit, view, pos, idf: which terms a unit needs the weights of."""
        part = F.pmod(F.xxhash64("id"), F.lit(self.parts)).cast("int")
        idf = F.array(
            *[
                F.struct(F.lit(v).alias("view"), F.col(f"{view}_idf").alias("idf"))
                for v, view in enumerate(self.views)
            ]
        )
        held = vectors.select(part.alias("part"), F.explode("indices").alias("index")).distinct()
        rows = held.join(vocab.drop("token"), "index").select("part", "index", F.inline(idf))
        rows = rows.where(F.col("idf").isNotNull()).select(
            (F.col("part") * len(self.views) + F.col("view")).alias("unit"),
            "view",
            F.col("index").cast("long").alias("pos"),
            "idf",
        )
        everywhere = vectors.sparkSession.range(self.parts * len(self.views)).select(
            F.col("id").cast("int").alias("unit"),
            (F.col("id") % len(self.views)).cast("int").alias("view"),
            F.lit(INTERCEPT).cast("long").alias("pos"),
            F.lit(1.0).alias("idf"),
        )
        return written(rows.unionByName(everywhere), "unit-terms")

    def solve(
        self, vectors: DataFrame, vocab: DataFrame, members: dict[str, Column]
    ) -> tuple[DataFrame, dict[tuple[str, int], float], int]:
        """Weights (view, pos, v0 …), relative gaps, and the passes taken."""
        count = spread_partitions(vectors.sparkSession, self.parts * len(self.views))
        units, terms = self.units(vectors, members, count), self.unit_terms(vectors, vocab)
        zero = [F.lit(0.0).alias(c) for c in self.values]
        weights = terms.select("view", "pos", *zero).limit(0)
        duals = terms.select("unit", "pos", *zero).limit(0)
        open_fits = {(v, i) for v in range(len(self.views)) for i in range(len(self.points))}
        gaps, passes = {}, 0
        try:
            while open_fits and passes < MOST_PASSES:
                passes += 1
                out = self.one_pass(units, terms, weights, duals, frozenset(open_fits), count)
                changes = out.where(F.col("kind") == WEIGHT).select("view", "pos", *self.values)
                before, weights = weights, written(
                    weights.unionByName(changes)
                    .groupBy("view", "pos")
                    .agg(*[F.sum(c).alias(c) for c in self.values]),
                    "weights",
                )
                duals = out.where(F.col("kind") == DUAL).select("unit", "pos", *self.values)
                found = self.gaps(before if self.parts > 1 else weights, out)
                gaps.update({fit: gap for fit, gap in found.items() if fit in open_fits})
                open_fits = {fit for fit in open_fits if gaps[fit] > TOLERANCE}
        finally:
            units.unpersist()
        if open_fits:
            warnings.warn(f"{len(open_fits)} linear fits stopped after {passes} passes", stacklevel=3)
        named = {(self.views[v], i): gap for (v, i), gap in gaps.items()}
        return weights, named, passes

    def one_pass(
        self, units: DataFrame, terms: DataFrame, weights: DataFrame, duals: DataFrame, open_fits: frozenset,
        count: int,
    ) -> DataFrame:
        """Every unit's changes, new duals and sums, written.

        What is sent is dealt as the units lie, so these stay there, and no two share a task
        because little is sent.
        """
        sent = terms.join(weights, ["view", "pos"], "left").select(
            "unit",
            F.lit(WEIGHT).alias("kind"),
            "pos",
            "idf",
            *[F.coalesce(c, F.lit(0.0)).alias(c) for c in self.values],
        )
        kept = duals.select(
            "unit", F.lit(DUAL).alias("kind"), "pos", F.lit(None).cast("double").alias("idf"), *self.values
        )
        schema = "unit int, view int, kind int, pos long, " + ", ".join(f"{c} double" for c in self.values)
        return written(
            units.groupBy("unit")
            .cogroup(sent.unionByName(kept).repartition(count, "unit").groupBy("unit"))
            .applyInArrow(self.improver(open_fits), schema),
            "linear-pass",
        )

    def improver(self, open_fits: frozenset):
        """The work of one unit in a pass."""
        points, views, parts, l2_norm, names = self.points, len(self.views), self.parts, self.l2_norm, self.values

        def improve(key, mails: pa.Table, sent: pa.Table) -> pa.Table:
            unit = key[0].as_py()
            view = unit % views
            n = len(mails)
            labels = mails.column("label").take(pc.sort_indices(mails.column("id"))).to_numpy()
            kind = sent.column("kind").to_numpy()
            pos = sent.column("pos").to_numpy()
            values = np.stack([sent.column(c).to_numpy() for c in names], axis=1)
            of_terms = np.flatnonzero(kind == WEIGHT)
            of_terms = of_terms[np.argsort(pos[of_terms])]  # the intercept comes first
            idf = sent.column("idf").to_numpy()[of_terms[1:]]
            weights = np.concatenate([values[of_terms[1:]], values[of_terms[:1]]])
            duals = np.zeros((n, len(points)))
            of_mails = np.flatnonzero(kind == DUAL)
            duals[pos[of_mails]] = values[of_mails]

            starts, columns, cells = unit_cells(mails, pos[of_terms[1:]], idf, l2_norm)
            signs = np.where(labels == SPAM, 1.0, -1.0)
            x = Cells(starts, columns, cells, len(idf), signs)
            sums, changes, new = np.zeros((2, len(points))), np.zeros_like(weights), duals.copy()
            last: dict[tuple[str, float], np.ndarray] = {}
            for i in sorted(range(len(points)), key=lambda i: points[i].cost):
                if n and (view, i) in open_fits:
                    # At first the solution at a lower cost is closer than zero is.
                    like = (points[i].loss, points[i].intercept_scale)
                    start = None if duals[:, i].any() else last.get(like)
                    new[:, i], changes[:, i], sums[0, i], sums[1, i], last[like] = local_solution(
                        x, points[i], weights[:, i], duals[:, i], parts, start
                    )
            changed = np.flatnonzero(changes.any(axis=1))
            places = np.append(pos[of_terms[1:]], INTERCEPT)[changed]
            rows = np.concatenate([changes[changed], new, sums])
            kinds = np.repeat(np.array([WEIGHT, DUAL, SUMS], np.int32), [len(changed), n, 2])
            return pa.table(
                {
                    "unit": np.full(len(rows), unit, np.int32),
                    "view": np.full(len(rows), view, np.int32),
                    "kind": kinds,
                    "pos": np.concatenate([places, np.arange(n), np.arange(2)]),
                    **{c: np.ascontiguousarray(rows[:, i]) for i, c in enumerate(names)},
                }
            )

        return improve

    def gaps(self, weights: DataFrame, out: DataFrame) -> dict[tuple[int, int], float]:
        """Relative duality gaps of the fits, from weights and the sums that belong to them."""
        norms = weights.groupBy("view", F.lit(2).cast("long").alias("pos")).agg(
            *[F.sum(F.col(c) * F.col(c)).alias(c) for c in self.values]
        )
        sums = out.where(F.col("kind") == SUMS).groupBy("view", "pos").agg(
            *[F.sum(c).alias(c) for c in self.values]
        )
        rows = {(r["view"], r["pos"]): r for r in sums.unionByName(norms).collect()}  # three a view
        found = {}
        for v, view in enumerate(self.views):
            for i, point in enumerate(self.points):
                loss, dual, norm = (
                    rows[v, kind][f"v{i}"] if (v, kind) in rows else 0.0 for kind in range(3)
                )
                at_zero = float(losses(point.loss, np.zeros(1))[0][0]) * self.sizes[view]
                found[v, i] = (norm + point.cost * loss - dual) / (point.cost * at_zero)
        return found


def unit_cells(
    mails: pa.Table, terms: np.ndarray, idf: np.ndarray, l2_norm: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row starts, columns and values of a unit's vectors in its own numbering of terms, in
    order of the mails' ids."""
    columns, values, sizes = [np.zeros(0, np.int32)], [np.zeros(0)], [np.zeros(0, np.int64)]
    for some in mails.select(["indices", "values"]).to_batches(max_chunksize=MAILS_AT_ONCE):
        lists = some.column("indices")
        indices = lists.flatten().to_numpy()
        cells = some.column("values").flatten().to_numpy()
        rows = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
        place = np.searchsorted(terms, indices)
        place[place == len(terms)] = 0
        known = np.flatnonzero(terms[place] == indices) if len(terms) else np.zeros(0, np.int64)
        rows, place = rows[known], place[known]
        cells = cells[known] * idf[place]
        if l2_norm:
            length = np.sqrt(np.bincount(rows, cells * cells, len(lists)))
            cells = cells / length[rows]
        columns.append(place.astype(np.int32))
        values.append(cells)
        sizes.append(np.bincount(rows, minlength=len(lists)))
    found = np.concatenate(sizes)
    starts = np.concatenate([[0], np.cumsum(found)]).astype(np.int64)
    columns, values = np.concatenate(columns), np.concatenate(values)
    order = pc.sort_indices(mails.column("id")).to_numpy()
    if (np.diff(order.astype(np.int64)) < 0).any():
        sorted_starts = np.concatenate([[0], np.cumsum(found[order])]).astype(np.int64)
        cells = np.repeat(starts[order] - sorted_starts[:-1], found[order]) + np.arange(len(columns))
        starts, columns, values = sorted_starts, columns[cells], values[cells]
    return starts, columns, values
