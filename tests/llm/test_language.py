import itertools

import numpy as np
import pytest

from mailspark.llm.language import (
    UNKNOWN,
    best_labels,
    held_out,
    language_column,
    language_model,
    predict,
)
from pyspark.sql import functions as F
from tests.llm.helpers import EDGE, empty, table

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def model(documents):
    return language_model(documents)


def test_held_out_accuracy(documents, model):
    found = predict(documents, model).join(documents, "doc_id")
    rows = found.where(held_out(F.col("doc_id"))).select("lang", "lang_pred", "score").collect()
    right = sum(r.lang == r.lang_pred for r in rows)
    assert len(rows) > 150 and right >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_rows_teach_nothing(documents, model):
    wrong = documents.withColumn(
        "lang", F.when(held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang"))
    )
    again = language_model(wrong)
    assert again.langs == model.langs and (again.scores == model.scores).all()


def test_spans_of_mixed_texts(spark, documents, model):
    parts = {}
    for r in documents.where("lang IN ('en', 'es')").orderBy("doc_id").collect():
        words = r.text.split()
        if len(words) > 150 and r.lang not in parts:
            parts[r.lang] = " ".join(words[:80])
    row = predict(table(spark, [(1, f"{parts['en']} {parts['es']}")]), model).first()
    assert [s.lang for s in row.spans] == ["en", "es"]
    assert abs(row.spans[1].start - 80) <= 3


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(3)
    scores = [rng.normal(0, 3, (n, 3)).astype(np.float32) for n in (0, 1, 2, 5, 6, 6)]
    for switch in (0.5, 3.0):
        for s, labels in zip(scores, best_labels(scores, switch)):
            def value(path, s=s):
                moves = sum(a != b for a, b in itertools.pairwise(path))
                return sum(float(s[i, x]) for i, x in enumerate(path)) - switch * moves
            best = max(map(value, itertools.product(range(3), repeat=len(s))))
            assert value(labels.tolist()) == pytest.approx(best, abs=1e-4)


def test_edge_rows(spark, model):
    rows = predict(table(spark, EDGE, more=[(9, "123 456 --")]), model).collect()
    assert len(rows) == len(EDGE) + 1
    for r in rows:
        assert (r.lang_pred == UNKNOWN) == (r.doc_id in (2, 3, 4, 9) or not r.spans)
        assert r.lang_pred in (*model.langs, UNKNOWN)


def test_column_agrees_with_table(spark, documents, model):
    some = documents.limit(40)
    found = some.select("doc_id", language_column(model)(F.col("text")).alias("f"))
    left = {r.doc_id: (r.f.lang_pred, r.f.score) for r in found.collect()}
    right = {r.doc_id: (r.lang_pred, r.score) for r in predict(some, model).collect()}
    assert left == right


def test_nothing_to_learn_from(spark):
    for docs in (empty(spark), table(spark, EDGE).withColumn("lang", F.lit(None).cast("string"))):
        nothing = language_model(docs)
        assert nothing.langs == ()
        found = predict(table(spark, EDGE), nothing).collect()
        assert {(r.lang_pred, r.score) for r in found} == {(UNKNOWN, 0.0)}


def test_empty_table(spark, model):
    assert predict(empty(spark), model).collect() == []
