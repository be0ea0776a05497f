"""Forests and boosted trees against plain recursion, and smaller grid points as parts."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from mailspark.config import WORD_1_2
from mailspark.operators import boosting, forest
from mailspark.operators.classifiers import GRIDS, drawn_share, forest_cut
from mailspark.operators.features import prepared_terms
from mailspark.operators.forest import Cut, Growth, Run, grow
from mailspark.operators.trees import (
    ABSENT,
    LEAF,
    NODE_COLUMNS,
    RATIO,
    ROOT,
    Binned,
    Tree,
    binned_vectors,
    children,
    draws,
    histogram,
    seed_of,
    tree_sums,
)
from mailspark.plans import train

CONFIG = WORD_1_2.with_changes(max_n=1)
WORDS = [f"word{c}" for c in "abcdefghij"]


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(90):
        spam = int(rng.random() < 0.4)
        words = [WORDS[int(w)] for w in (rng.integers(0, 8, rng.integers(1, 9)) + 2 * spam) % 10]
        rows.append((f"m{i}", spam, " ".join(words), f"p/{i}"))
    rows += [("odd", 1, "zzz", "p/o"), ("copy", 0, rows[0][2], "p/c")]
    mails = spark.createDataFrame(rows, "id string, label int, text string, path string")
    return prepared_terms(train.split_mails(mails.withColumn("label_name", F.lit(""))), CONFIG)


@pytest.fixture(scope="module")
def data(docs):
    return train.binned_train(docs, CONFIG, None)


@pytest.fixture(scope="module")
def mails(data):
    """(id, label, {term: bin}) of the train mails."""
    return [
        (r.id, r.label, {t: b for t, b in zip(r.indices, r.bins_final) if b != ABSENT})
        for r in data.vectors.collect()
    ]


def rows_of(nodes):
    return sorted(tuple(r) for r in nodes.select(*NODE_COLUMNS).collect())


def plain_forest(mails, depth, least):
    """(node, term, edge, value) of one tree that draws nothing, by recursion."""
    found = []

    def split(node, some, level):
        g, h = sum(m[1] for m in some), len(some)
        best = None
        if g not in (0, h) and h >= least and level < depth:
            for term in sorted({t for m in some for t in m[2]}):
                for edge in sorted({m[2][term] for m in some if term in m[2]}):
                    right = [m for m in some if m[2].get(term, ABSENT) >= edge]
                    a, b = sum(m[1] for m in right), len(right)
                    if b < h:
                        gain = (g - a) ** 2 / (h - b) + a * a / b - g * g / h
                        if best is None or gain > best[0]:
                            best = (gain, term, edge, right)
        value = g / h if h else 0.0
        if best is None:
            found.append((node, LEAF, 0, value))
            return
        _, term, edge, right = best
        found.append((node, term, edge, value))
        for side, part in enumerate(([m for m in some if m not in right], right)):
            split(int(children(np.array([node]), np.array([bool(side)]))[0]), part, level + 1)

    split(ROOT, mails, 0)
    return sorted(found)


@pytest.mark.parametrize("depth, least", [(1, 2), (3, 2), (1 << 30, 2), (1 << 30, 12)])
def test_a_tree_that_draws_nothing(data, mails, depth, least):
    growth = Growth((Run("final", None, 1.0),), 1, depth, least, bootstrap=False)
    nodes = grow(data.vectors, growth).nodes.select("node", "term", "edge", "value").collect()
    assert sorted((r.node, r.term, 0 if r.term == LEAF else r.edge, r.value) for r in nodes) == plain_forest(
        mails, depth, least
    )


def test_smaller_points_are_parts_of_the_largest(docs):
    """Votes at a cut are those of a forest that is grown no further."""
    data = train.binned_train(docs, CONFIG, 3)
    runs = tuple(Run(f"cv{k}", k, 0.3) for k in range(3))
    cuts = (Cut(1 << 30, 2), Cut(2, 2), Cut(1 << 30, 8), Cut(3, 8))
    votes = {
        (r.run, r.cut, r.trees, r.id): r.vote
        for r in grow(data.vectors, Growth(runs, 5, 1 << 30, 2, cuts, (2, 5))).votes.collect()
    }
    held = data.vectors.groupBy("fold").count().collect()
    assert len(votes) == sum(r["count"] for r in held) * len(cuts) * 2
    for c, cut in enumerate(cuts[1:], 1):
        for trees in (2 + 3 * (c % 2),):
            small = grow(data.vectors, Growth(runs[:1], trees, cut.depth, cut.least))
            vocab = data.vocab.where("cv0_idf is not null").select("token", "index", F.col("cv0_idf").alias("idf"))
            mails = docs.where("fold = 0").select("id", "label", "terms")
            sums = tree_sums(mails, vocab, small.nodes, CONFIG).collect()
            for r in sums:
                assert votes[0, c, trees, r.id] == pytest.approx(r.tree_sum / trees, abs=1e-6)


def test_every_tree_ends_pure_or_tried_all_terms(data, mails):
    """Nodes draw again until a term splits them."""
    kinds = {}
    for _, label, cells in mails:
        kinds.setdefault(tuple(sorted(cells.items())), set()).add(label)
    mixed_kinds = sum(len(k) > 1 for k in kinds.values())
    forest_ = grow(data.vectors, Growth((Run("final", None, 1e-3),), 2))
    leaves = forest_.nodes.where(F.col("term") == LEAF).select("value").collect()
    assert len(leaves) > 12 and sum(0 < r.value < 1 for r in leaves) <= 2 * mixed_kinds


def test_forests_and_boosting_do_not_depend_on_parts(data, monkeypatch):
    growth = Growth((Run("final", None, 0.4),), 4, 4)
    runs = (boosting.Run("final", None, 3, 0.3, 0.8, 0.8), boosting.Run("final", None, 2, 0.1))
    found = []
    for cells in (1_000_000, 20):
        monkeypatch.setattr("mailspark.operators.trees.CELLS_PER_PART", cells)
        boosted = boosting.boost(data.vectors, runs, 4)
        found.append((rows_of(grow(data.vectors, growth).nodes), sorted(boosted.nodes), boosted.losses))
    assert found[0][:2] == found[1][:2]
    assert found[0][2][0] == pytest.approx(found[1][2][0], abs=1e-9)


def plain_boosting(mails, depth, rate, rounds):
    """Margins after each round, by recursion over all splits and both default sides."""
    margins, history = {m[0]: 0.0 for m in mails}, []
    for _ in range(rounds):
        p = {i: 1 / (1 + np.exp(-v)) for i, v in margins.items()}
        g = {m[0]: p[m[0]] - m[1] for m in mails}
        h = {i: v * (1 - v) for i, v in p.items()}

        def total(some):
            return sum(g[m[0]] for m in some), sum(h[m[0]] for m in some)

        def value(a, b):
            return a * a / (b + 1.0)

        def split(some, level):
            gs, hs = total(some)
            best = None
            if level < depth:
                for term in {t for m in some for t in m[2]}:
                    for edge in {m[2][term] for m in some if term in m[2]}:
                        for default in (False, True):
                            right = [m for m in some if (m[2][term] >= edge if term in m[2] else default)]
                            a, b = total(right)
                            if b >= 1.0 and hs - b >= 1.0:
                                gain = value(a, b) + value(gs - a, hs - b) - value(gs, hs)
                                if gain > 1e-6 and (best is None or gain > best[0]):
                                    best = gain, right
            if best is None:
                for m in some:
                    margins[m[0]] += -rate * gs / (hs + 1.0)
                return
            ids = {m[0] for m in best[1]}
            split([m for m in some if m[0] not in ids], level + 1)
            split(best[1], level + 1)

        split(mails, 0)
        history.append(dict(margins))
    return history


def test_boosting_against_recursion(docs, data, mails, monkeypatch):
    monkeypatch.setattr(boosting, "STAGE", 2)
    run = boosting.Run("final", None, 2, 0.3)
    boosted = boosting.boost(data.vectors, (run,), 3)
    expected = plain_boosting(mails, 2, 0.3, 3)
    labels = {m[0]: m[1] for m in mails}
    for n, margins in enumerate(expected):
        loss = np.mean([np.logaddexp(0, -v if labels[i] else v) for i, v in margins.items()])
        assert boosted.losses[0][n + 1] == pytest.approx(loss, abs=1e-6)
    vocab = data.vocab.select("token", "index", F.col("final_idf").alias("idf"))
    spark = docs.sparkSession
    nodes = spark.createDataFrame(
        boosted.tree_rows(0, 3), "tree int, node long, term long, edge int, absent_right boolean, value double"
    )
    sums = tree_sums(docs.where("fold is not null").select("id", "terms"), vocab, nodes, CONFIG).collect()
    assert {r.id: r.tree_sum for r in sums} == pytest.approx(expected[-1], abs=1e-6)


def test_runs_advance_together_as_alone(docs):
    data = train.binned_train(docs, CONFIG, 3)
    runs = tuple(
        boosting.Run(f"cv{k}", k, depth, 0.3, 0.8, 0.8) for depth in (1, 3) for k in range(3)
    )
    together = boosting.boost(data.vectors, runs, 3, (2, 3))
    alone = boosting.boost(data.vectors, runs[4:5], 3, (2, 3))
    assert [r[1:] for r in together.nodes if r[0] == 4] == [r[1:] for r in alone.nodes]
    for rounds in (2, 3):
        assert together.counts[4, rounds] == alone.counts[0, rounds]
        assert set(boosting.mean_f1(together, runs, rounds)) == {
            boosting.Run("", None, d, 0.3, 0.8, 0.8) for d in (1, 3)
        }
    shorter = boosting.boost(data.vectors, runs[4:5], 2)
    assert shorter.nodes == [r for r in alone.nodes if r[1] < 2]


@pytest.mark.parametrize("name", ["rf", "xgb"])
def test_search_takes_the_point_with_the_best_mean(docs, monkeypatch, name):
    monkeypatch.setattr("mailspark.config.FOREST_TREES", (2, 4))
    grid = [p for p in GRIDS[name] if p["clf__n_estimators"] == GRIDS[name][0]["clf__n_estimators"]]
    small = {"rf": (2, 4), "xgb": (1, 2)}[name]
    grid = [{**p, "clf__n_estimators": n} for n in small for p in grid[:6]]
    best, score = train.SEARCHES[name](docs, CONFIG, grid, 3)
    assert best in grid and 0 <= score <= 1
    again, same = train.SEARCHES[name](docs, CONFIG, [best], 3)
    assert (again, same) == (best, score)


def test_draws_are_even_and_fixed():
    values = draws(seed_of(1, 2), np.arange(20_000))
    assert np.histogram(values, 10, (0, 1))[0] == pytest.approx(2000, rel=0.1)
    assert (values == draws(seed_of(1, 2), np.arange(20_000))).all()
    assert abs(np.corrcoef(values, draws(seed_of(1, 3), np.arange(20_000)))[0, 1]) < 0.03
    weights = Growth((), 1).weights(0, np.arange(20_000, dtype=np.uint64), np.ones(20_000, bool))
    assert weights.mean() == pytest.approx(1.0, abs=0.03) and (weights == 0).mean() == pytest.approx(0.368, abs=0.02)


def test_histogram_and_lookup():
    groups, terms, bins = np.array([1, 0, 1, 1]), np.array([5, 5, 5, 2]), np.array([-3, 0, -3, 4])
    found = histogram(groups, terms, bins, [np.array([1, 2, 3, 4])])
    assert sorted(zip(*map(list, found))) == [(0, 5, 0, 2), (1, 2, 4, 4), (1, 5, -3, 4)]
    assert len(histogram(*[np.zeros(0, np.int64)] * 3, [np.zeros(0)])[0]) == 0
    x = Binned(np.array([0, 0, 2]), np.array([1, 4, 1]), np.array([-2, -3, -4]), 3)
    assert x.lookup(x.keys(), np.array([0, 1, 2, 2]), np.array([4, 1, 1, 9])).tolist() == [-3, ABSENT, -4, ABSENT]
    tree = Tree.of([(ROOT, LEAF, 0, False, 0.5)])
    assert tree.predict(x, x.keys()).tolist() == [0.5] * 3


def test_what_points_stand_for():
    assert forest_cut({"clf__max_depth": None, "clf__min_samples_split": 5}) == Cut(forest.NO_LIMIT, 5)
    assert drawn_share("sqrt", 100) == 0.1 and drawn_share("log2", 1024) == 10 / 1024
    assert drawn_share("sqrt", 1) == 1.0




def test_vectors_of_long_mails_take_no_shuffle_of_cells(spark):
    """a mail's length was summed anew for each of its terms, and cells went by id."""
    cells = [(f"t{i:05}", 1) for i in range(20_000)]
    docs = spark.createDataFrame([("a", 0, 0, cells), ("b", 1, 0, [*cells, ("u", 1)]), ("c", 1, 0, [])],
                                 "id string, label int, fold int, terms array<struct<token:string,tf:int>>")
    config = CONFIG.with_changes(max_df=1.0)
    data = train.binned_train(docs, config, None)
    rows = {r.id: r for r in data.vectors.collect()}
    assert sorted(rows["a"].indices) == rows["b"].indices == list(range(20_000)) and rows["c"].indices == []
    assert set(rows["a"].bins_final) == {math.floor(math.log(20_000**-0.5) / math.log(RATIO))}
    plan = binned_vectors(docs, data.vocab.withColumnRenamed("idf", "final_idf"), ["final"], config)
    assert "hashpartitioning(id" not in plan._jdf.queryExecution().executedPlan().toString()


def test_no_node_is_a_hot_group(data):
    """all sums of the root, whatever their term, went to one task."""
    sums = data.vectors.sparkSession.createDataFrame([], forest.SCHEMA)
    found = forest.decisions(sums, Growth((Run("final", None, 1.0),), 1))
    dealt = [l for l in found._jdf.queryExecution().executedPlan().toString().splitlines() if "REPARTITION_BY" in l]
    assert dealt and all("term" in line for line in dealt)


def test_sums_leave_a_part_as_arrays(data):
    """a row for each node, term and bin of every part went through Spark at each level."""
    vectors = data.vectors.toArrow()
    run, growing, keys = boosting.Run("final", None, 2, 0.3), boosting.Growing(), [4, 7, 9]
    packed = list(boosting.packer(["final"], 1, 3)(vectors.to_batches()))
    assert len(packed) == 1 and packed[0].num_rows == 1
    (sums,) = boosting.level_sums((run,), [growing], {0: [ROOT]}, 0, keys, True)(packed)
    assert sums.column("key").to_pylist() == keys
    found = {}
    for share, row in enumerate(sums.to_pylist()):
        terms, bins, g, h = (np.frombuffer(row[c], boosting.SUMS[c]).tolist() for c in ("terms", "bins", "g", "h"))
        assert {t % 3 for t in terms} <= {share}
        found |= dict(zip(zip(terms, bins), zip(g, h)))
    unit, expected = 1 << boosting.SCALE_BITS, {}
    for mail in vectors.to_pylist():
        for cell in zip(mail["indices"], mail["bins_final"]):
            g, h = expected.get(cell, (0, 0))
            expected[cell] = g + unit // 2 - mail["label"] * unit, h + unit // 4
    assert found == expected


@pytest.mark.parametrize("at_once", [7, 1 << 15])
def test_drawn_cells_are_those_of_the_draws(monkeypatch, at_once):
    """draws of all cells were made over again in arrays as long as the part."""
    monkeypatch.setattr(forest, "CELLS_AT_ONCE", at_once)
    rng = np.random.default_rng(3)
    rows = np.sort(rng.integers(0, 40, 500))
    x = Binned(rows, rng.integers(0, 90, 500), rng.integers(-9, 0, 500), 40)
    group_of = rng.integers(-1, 3, 40)
    seeds = forest.draws_seed(seed_of(5), np.array([ROOT, 77, 1 << 60]))
    above, upto = np.array([0.0, 0.1, 0.3]), np.array([0.2, 0.8, 1.0])
    cells, groups, drawn = forest.drawn_cells(x, group_of, seeds, above, upto)
    wanted = []
    for c in range(500):
        g = group_of[rows[c]]
        if g >= 0 and above[g] <= (d := draws(seeds[g], x.terms[c : c + 1])[0]) < upto[g]:
            wanted.append((c, g, d))
    assert list(zip(cells.tolist(), groups.tolist(), drawn.tolist())) == wanted and len(wanted) > 100
    assert [len(a) for a in forest.drawn_cells(x, group_of, seeds[:0], above, upto)] == [0, 0, 0]
