"""The linear solver against a dense solution, other solvers and finite differences."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from mailspark.config import WORD_1_2
from mailspark.operators import linear
from mailspark.operators.classifiers import FREE_INTERCEPT
from mailspark.operators.features import prepared_terms, vocabulary
from mailspark.operators.linear import (
    LOGISTIC,
    SQUARED_HINGE,
    Cells,
    Point,
    dual_values,
    local_solution,
    losses,
    search,
)
from mailspark.operators.vectors import feature_vectors, with_index
from mailspark.plans import train
from mailspark.sources.scratch import written

CONFIG = WORD_1_2.with_changes(max_n=1)
WORDS = [f"word{c}" for c in "abcdefghijklmnopqrst"]
POINTS = (Point(SQUARED_HINGE, 0.1), Point(SQUARED_HINGE, 10.0), Point(LOGISTIC, 1.0),
          Point(LOGISTIC, 10.0, FREE_INTERCEPT))


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(150):
        spam = int(rng.random() < 0.35)
        shift = 4 if spam else 0
        words = [WORDS[int(w)] for w in (rng.integers(0, 14, rng.integers(1, 12)) + shift) % 20]
        rows.append((f"m{i}", spam, " ".join(words), f"p/{i}"))
    rows.append(("empty", 0, "zzz", "p/e"))
    rows += [(f"copy{i}", 1, rows[0][2], f"p/c{i}") for i in range(30)]
    mails = spark.createDataFrame(rows, "id string, label int, text string, path string")
    return prepared_terms(train.split_mails(mails.withColumn("label_name", F.lit(""))), CONFIG)


def matrix(docs, view):
    """Dense vectors, labels and terms of a view's training mails."""
    kept = docs.where("fold is not null")
    if view != "final":
        kept = kept.where(F.col("fold") != int(view[2:]))
    vocab = {r.token: (i, r.idf) for i, r in enumerate(vocabulary(kept, CONFIG).collect())}
    rows = kept.collect()
    x = np.zeros((len(rows), len(vocab)))
    for n, row in enumerate(rows):
        for term in row.terms:
            if term.token in vocab:
                i, idf = vocab[term.token]
                x[n, i] = (1 + np.log(term.tf)) * idf
    lengths = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(lengths, lengths, 1), np.array([2 * r.label - 1 for r in rows]), list(vocab)


def dense_solution(x, y, point):
    """Damped Newton on the whole problem."""
    rows = np.hstack([x, np.full((len(x), 1), point.intercept_scale)]) * y[:, None]
    w = np.zeros(rows.shape[1])

    def objective(w):
        return w @ w / 2 + point.cost * losses(point.loss, rows @ w)[0].sum()

    for _ in range(200):
        _, down, curvature = losses(point.loss, rows @ w)
        g = w - point.cost * rows.T @ down
        if np.linalg.norm(g) < 1e-10:
            break
        step = np.linalg.solve(np.eye(len(w)) + point.cost * (rows.T * curvature) @ rows, -g)
        t = 1.0
        while objective(w + t * step) > objective(w) + 1e-4 * t * (g @ step) and t > 1e-12:
            t /= 2
        w = w + t * step
    return w[:-1], w[-1] * point.intercept_scale, objective(w)


def check(found, docs):
    for view in ("final", "cv0", "cv1", "cv2"):
        x, y, tokens = matrix(docs, view)
        for i, point in enumerate(found.points):
            w, b, _ = dense_solution(x, y, point)
            rows = {r.token: r.w for r in found.table.select("token", F.col(f"{view}_{i}").alias("w")).collect()}
            assert [rows[t] for t in tokens] == pytest.approx(w, abs=2e-2 * max(1, np.abs(w).max()))
            assert found.intercepts[view, i] == pytest.approx(b, abs=2e-2 * max(1, abs(b)))
            assert all(v == 0 for t, v in rows.items() if t not in tokens)
            assert 0 <= found.gaps[view, i] <= linear.TOLERANCE


def test_all_fits_against_a_dense_solution(docs):
    found = search(docs, CONFIG, POINTS, 3)
    assert found.passes <= 2  # one part
    check(found, docs)


def test_many_parts_give_the_same_fits(docs, monkeypatch):
    monkeypatch.setattr(linear, "MAILS_PER_PART", 80)
    found = search(docs, CONFIG, POINTS[:1] + POINTS[2:3], 3)
    assert found.passes > 2
    check(found, docs)


def test_logistic_regression_against_mllib(docs):
    kept = docs.where("fold is not null")
    vocab = written(with_index(vocabulary(kept, CONFIG)), "v")
    vectors = feature_vectors(kept, vocab, vocab.count(), CONFIG)
    n = vectors.count()
    other = LogisticRegression(regParam=1 / (10.0 * n), standardization=False, tol=1e-10, maxIter=500)
    own = other.fit(vectors).transform(vectors).select("id", vector_to_array("probability")[1].alias("p"))
    point = {"clf__C": 10.0, "clf__max_iter": 1000, "clf__solver": "lbfgs"}
    scored = train._train_linear("lr", docs, CONFIG, [point], None).score_terms(kept)
    pairs = scored.join(own, "id").collect()
    assert len(pairs) == n
    assert [r.score for r in pairs] == pytest.approx([r.p for r in pairs], abs=2e-3)


def test_margins_come_from_the_view_without_the_mail(docs):
    found = search(docs, CONFIG, POINTS[:1], 3)
    rows = {r.id: r.margin_0 for r in found.margins(docs).collect()}
    kept = {r.id: r for r in docs.collect()}
    for view in ("final", "cv0", "cv1", "cv2"):
        weights = {r.token: (r.idf, r.w) for r in found.table.where(f"{view}_idf is not null").select(
            "token", F.col(f"{view}_idf").alias("idf"), F.col(f"{view}_0").alias("w")).collect()}
        for i, row in kept.items():
            if (row.fold is None and view == "final") or f"cv{row.fold}" == view:
                cells = [(np.log(t.tf) + 1) * weights[t.token][0] for t in row.terms if t.token in weights]
                ws = [weights[t.token][1] for t in row.terms if t.token in weights]
                length = np.sqrt(np.dot(cells, cells)) or 1
                assert rows[i] == pytest.approx(np.dot(cells, ws) / length + found.intercepts[view, 0], abs=1e-9)


def test_fold_f1_is_the_mean_over_folds(docs):
    found = search(docs, CONFIG, POINTS[:2], 3)
    kept = docs.where("fold is not null").select("id", "label", "fold", "terms")
    rows = found.margins(kept).collect()
    for i, mean in enumerate(found.fold_f1(kept)):
        scores = []
        for fold in range(3):
            pairs = [(r.label, int(r[f"margin_{i}"] > 0)) for r in rows if r.fold == fold]
            tp, wrong = pairs.count((1, 1)), sum(a != b for a, b in pairs)
            scores.append(2 * tp / (2 * tp + wrong) if tp else 0.0)
        assert mean == pytest.approx(sum(scores) / 3, abs=1e-9)


@pytest.mark.parametrize("loss", [SQUARED_HINGE, LOGISTIC])
def test_a_part_lowers_the_gap_whatever_the_others_do(loss):
    """Adding the changes of all parts never lowers the dual."""
    rng = np.random.default_rng(3)
    point, parts, width = Point(loss, 0.5), 4, 30
    cells = []
    for _ in range(parts):
        rows = [np.sort(rng.choice(width, rng.integers(0, 6), replace=False)) for _ in range(25)]
        starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        columns = np.concatenate(rows)
        cells.append(Cells(starts, columns, rng.random(len(columns)), width, rng.choice([-1.0, 1.0], 25)))
    weights, duals = np.zeros(width + 1), [np.zeros(25) for _ in cells]

    def gap():
        loss_sum = sum(losses(loss, c.margins(weights, 1.0))[0].sum() for c in cells)
        dual = sum(dual_values(loss, d, point.cost).sum() for d in duals) - weights @ weights / 2
        return weights @ weights / 2 + point.cost * loss_sum - dual, dual

    last = gap()[1]
    for _ in range(200):  # noisy labels and four parts that share all terms: slow, but sure
        found = [local_solution(c, point, weights, d, parts) for c, d in zip(cells, duals)]
        duals = [f[0] for f in found]
        weights = weights + sum(f[1] for f in found)
        assert weights == pytest.approx(sum(c.weighted_sum(d, 1.0) for c, d in zip(cells, duals)))
        width_of_gap, dual = gap()
        assert width_of_gap >= -1e-9 and dual >= last - 1e-6
        last = dual
        if width_of_gap <= linear.TOLERANCE * point.cost * 100:
            break  # a fit that is done is left out
    assert width_of_gap < 1e-3 * point.cost * 100


@pytest.mark.parametrize("loss", [SQUARED_HINGE, LOGISTIC])
def test_slopes_against_differences(loss):
    m = np.linspace(-3, 3, 41) + 0.013
    value, down, curvature = losses(loss, m)
    h = 1e-5
    assert -down == pytest.approx((losses(loss, m + h)[0] - losses(loss, m - h)[0]) / (2 * h), abs=1e-5)
    assert curvature == pytest.approx(-(losses(loss, m + h)[1] - losses(loss, m - h)[1]) / (2 * h), abs=1e-4)


def test_a_view_without_spam_raises(docs):
    with pytest.raises(ValueError, match="no training mails"):
        search(docs.withColumn("label", F.lit(0)), CONFIG, POINTS[:1], 3)


def test_a_part_keeps_its_cells_once(monkeypatch):
    """cells were kept by row and by column, with 8 bytes for each number."""
    rng = np.random.default_rng(3)
    dense = np.where(rng.random((200, 50)) < 0.2, rng.random((200, 50)), 0.0)
    dense[[0, 17, 199]] = 0.0
    rows, columns = np.nonzero(dense)
    starts = np.searchsorted(rows, np.arange(201))
    signs = np.where(rng.random(200) < 0.5, 1.0, -1.0)
    weights, amounts, some = rng.random(51), rng.random(200), np.arange(3, 200, 7)
    for at_once in (1, 37, 10_000):
        monkeypatch.setattr(linear, "CELLS_AT_ONCE", at_once)
        cells = Cells(starts, columns, dense[rows, columns], 50, signs)
        held = sum(a.nbytes for a in vars(cells).values() if isinstance(a, np.ndarray) and len(a) == len(rows))
        assert held <= 12 * len(rows)
        for x, which in ((cells, np.arange(200)), (cells.only(some), some)):
            margins = signs[which] * (dense[which] @ weights[:-1] + 2.0 * weights[-1])
            assert x.margins(weights, 2.0) == pytest.approx(margins)
            sums = (signs * amounts)[which]
            expected = np.append(sums @ dense[which], 2.0 * sums.sum())
            assert x.weighted_sum(amounts[which], 2.0) == pytest.approx(expected)


def test_units_have_tasks_of_their_own(docs, monkeypatch):
    """little is sent to units, so adaptive execution put several in one task."""
    seen, gaps = [], linear.Problem.gaps
    monkeypatch.setattr(linear.Problem, "gaps", lambda self, w, out: seen.append(out) or gaps(self, w, out))
    search(docs, CONFIG, POINTS[:1], 3)
    tasks = seen[0].groupBy(F.input_file_name().alias("task")).agg(F.countDistinct("unit").alias("n")).collect()
    assert [r["n"] for r in tasks] == [1] * 4
