import numpy as np
import pytest
from pyspark.sql import functions as F

from mailspark.llm import mil_quality
from mailspark.llm.mil_quality import (
    FEATURES,
    Network,
    _bags,
    fit,
    held_out,
    initial,
    learn,
    passages,
    quality_model,
    score_documents,
)
from tests.llm.helpers import EDGE, empty, table

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{FOLDER}/labels.parquet")


@pytest.fixture(scope="module")
def net(documents, labels):
    return quality_model(documents, labels)


def test_held_out_documents_are_told_apart(documents, labels, net):
    found = score_documents(documents, net).join(labels, "doc_id").where(held_out(F.col("doc_id")))
    rows = found.select("score", "quality").collect()
    good = np.array([r.score for r in rows if r.quality == 1])
    bad = np.array([r.score for r in rows if r.quality == 0])
    assert len(good) > 40 and len(bad) > 5
    assert (good[:, None] > bad[None, :]).mean() > 0.97
    assert ((good >= 0.3).sum() + (bad < 0.3).sum()) / len(rows) > 0.95


def test_held_out_labels_teach_nothing(documents, labels, net):
    wrong = labels.withColumn(
        "quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    again = quality_model(documents, wrong)
    assert all((again.weights[k] == net.weights[k]).all() for k in net.weights)


def test_scores_do_not_depend_on_other_texts(net):
    texts = ["", "a b a b", "One two.\n" * 200, "THE!! END!!", "x" * 3000, "é 日本 " * 90]
    together = net.scores(texts)
    assert together == pytest.approx([net.scores([t])[0] for t in texts], abs=1e-6)
    assert ((together >= 0) & (together <= 1)).all()


def test_a_bad_passage_counts_wherever_it_stands(documents, labels, net):
    good = documents.join(labels, "doc_id").where("quality = 1 AND length(text) BETWEEN 3000 AND 6000")
    text = good.orderBy("doc_id").first().text
    bad = "BUY!! NOW!! THE!! BEST!! " * 120
    score = net.scores([text])[0]
    assert all(s < score for s in net.scores([bad + text, text + bad, text[:1500] + bad + text[1500:]]))


def test_passages_of_a_text():
    words = [f"w{i}" for i in range(130)]
    found = passages([" ".join(words), "", "  lead", "a a a"])
    assert found.counts().tolist() == [3, 1, 1, 1]
    assert found.features.shape == (6, FEATURES) and np.isfinite(found.features).all()
    by_word = found.features[:, -7:]
    assert by_word[0, 1] == 0 and by_word[5, 2] == pytest.approx(2 / 3)
    alone = passages([" ".join(words)])
    assert (alone.features == found.features[:3]).all()


def test_gradients_against_differences():
    rng = np.random.default_rng(4)
    bags = _bags([rng.normal(0, 1, (n, 5)) for n in (1, 3, 2)])
    labels = np.array([1.0, 0.0, 1.0])
    weights = {k: np.asarray(v, np.float64) for k, v in initial(bags.features, 0.6).items()}
    found = Network(weights).gradients(bags, labels)

    def loss(changed):
        p = Network(changed).forward(bags)["p"]
        return -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean()

    for name, gradient in found.items():
        flat = np.atleast_1d(weights[name]).ravel()
        for at in range(0, len(flat), max(1, len(flat) // 5)):
            sides = []
            for move in (1e-5, -1e-5):
                moved = flat.copy()
                moved[at] += move
                sides.append(loss({**weights, name: moved.reshape(np.shape(weights[name]))}))
            assert np.atleast_1d(gradient).ravel()[at] == pytest.approx((sides[0] - sides[1]) / 2e-5, abs=1e-6)


def test_nothing_to_learn(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert set(quality_model(documents, none).scores(["a", ""])) == {0.5}
    ones = spark.createDataFrame([(i, 1) for i in range(50)], "doc_id long, quality int")
    assert set(quality_model(documents, ones).scores(["a"])) == {1.0}
    assert fit([], np.zeros(0)).constant == 0.5


def test_the_sample_is_bounded(documents, labels, monkeypatch):
    monkeypatch.setattr(mil_quality, "MAX_PASSAGES", 300)
    seen = []
    monkeypatch.setattr(mil_quality, "fit", lambda bags, y: seen.append((len(bags), sum(map(len, bags)))))
    learn(documents, labels.select("doc_id", F.col("quality").alias("label")), most=100)
    assert 0 < seen[0][0] <= 100 and seen[0][1] <= 300


def test_edge_rows(spark, net):
    docs = table(spark, EDGE)
    rows = score_documents(docs, net).collect()
    assert len(rows) == len(EDGE) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r, (_, t) in zip(rows, EDGE) if not t}) == 1
    marks = docs.select("doc_id", F.lit(1).alias("quality")).limit(4).unionByName(
        docs.select("doc_id", F.lit(0).alias("quality"))
    )
    again = quality_model(docs, marks.unionByName(marks.select("doc_id", F.lit(None).cast("int").alias("quality"))))
    assert score_documents(docs, again).count() == len(EDGE)
    assert score_documents(empty(spark), net).count() == 0
