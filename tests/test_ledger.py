"""Saved models change as a whole; experiments go on where they were cut off."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from mailspark.config import WORD_1_2
from mailspark.operators import linear
from mailspark.plans import model as models
from mailspark.plans import train
from mailspark.plans.ledger import Ledger, fingerprint
from mailspark.plans.model import LatestModel, current_version, load_model, save_model
from mailspark.sources.publish import children_of, publish_text, published_text
from mailspark.sources.scratch import scratch_path
from mailspark.streaming.score import score_stream

CONFIG = WORD_1_2.with_changes(max_n=1)
FOREST = [
    {"clf__n_estimators": 2, "clf__max_depth": d, "clf__min_samples_split": 2, "clf__max_features": "sqrt"}
    for d in (1, 2)
]


@pytest.fixture(scope="module")
def parts(spark):
    rows = []
    for i in range(45):
        words = ("win", "cash", "prize") if i % 3 == 0 else ("meeting", "report", "lunch")
        rows.append((f"m{i}", int(i % 3 == 0), " ".join(words[(i + k) % 3] for k in range(1 + i % 3)), f"p/{i}"))
    mails = spark.createDataFrame(rows, "id string, label int, text string, path string")
    return train.split_mails(mails.withColumn("label_name", F.lit("")))


@pytest.fixture(scope="module")
def model(parts):
    return train.train_model("nb", parts, [CONFIG])


def test_files_are_replaced_as_a_whole(spark):
    path = scratch_path(spark, "published") + "/FILE"
    assert published_text(spark, path) is None
    for text in ("one", "two\nlines ✓", "three"):
        publish_text(spark, path, text)
        assert published_text(spark, path) == text
    folder = path.rsplit("/", 1)[0]
    assert [n for _, n in children_of(spark, folder) if not n.endswith(".crc")] == ["FILE"]


def test_a_save_that_is_cut_off_changes_nothing(spark, model, monkeypatch):
    path = scratch_path(spark, "model")
    first = save_model(model, path)
    other = replace(model, intercept=5.0)

    def fail(spark, target, text):
        if target.endswith(models.POINTER):
            raise OSError("the driver is lost here")
        publish_text(spark, target, text)

    monkeypatch.setattr(models, "publish_text", fail)
    with pytest.raises(OSError):
        save_model(other, path)
    assert current_version(spark, path) == first
    assert load_model(spark, path).intercept == model.intercept


def test_readers_of_the_old_version_keep_it(spark, parts, model):
    path = scratch_path(spark, "model")
    first = save_model(model, path)
    old = load_model(spark, path)
    second = save_model(model, path)
    assert current_version(spark, path) == second != first
    assert old.score(parts.select("id", "text"), keep_text=False).count() == 45
    assert load_model(spark, path, first).params == model.params
    save_model(model, path)
    names = [n for _, n in children_of(spark, f"{path}/versions")]
    assert len(names) == models.KEPT_VERSIONS and first not in names


def test_no_model(spark):
    with pytest.raises(FileNotFoundError):
        load_model(spark, scratch_path(spark, "nothing"))


def test_a_stream_takes_up_a_new_version(spark, model):
    path, out = scratch_path(spark, "model"), scratch_path(spark, "stream")
    save_model(model, path)
    latest = LatestModel(path)
    source = f"{out}/mails"
    for n, intercept in enumerate((model.intercept, 50.0)):
        if n:
            save_model(replace(model, intercept=intercept), path)
        spark.createDataFrame([(f"s{n}", "report lunch")], "id string, text string").write.mode("append").parquet(source)
        stream = spark.readStream.schema("id string, text string").parquet(source)
        score_stream(stream, latest, f"{out}/scored", f"{out}/progress").awaitTermination()
    found = {r.id: r.prediction for r in spark.read.parquet(f"{out}/scored").collect()}
    assert found == {"s0": 0, "s1": 1}


def test_a_finished_search_is_not_done_again(spark, parts, monkeypatch):
    folder, grid = scratch_path(spark, "ledger"), [{"clf__C": 1.0}, {"clf__C": 10.0}]
    ledger = Ledger.of(folder, parts)
    first = train.train_model("svm", parts, [CONFIG], grid, ledger=ledger)

    def never(*args):
        raise AssertionError("searched again")

    monkeypatch.setattr(linear, "search", never)
    again = train.train_model("svm", parts, [CONFIG], grid, ledger=Ledger.of(folder, parts.repartition(3)))
    assert (again.params, again.cv_f1, again.gap) == (first.params, first.cv_f1, first.gap)
    test = parts.where("split = 'test'").select("id", "text")
    scores = [sorted(tuple(r) for r in m.score(test, keep_text=False).collect()) for m in (first, again)]
    assert scores[0] == scores[1]
    with pytest.raises(AssertionError):
        train.train_model("svm", parts, [CONFIG], grid[:1], ledger=ledger)


def test_a_run_that_was_cut_off_after_a_search_goes_on_with_the_refit(spark, parts, monkeypatch):
    ledger = Ledger.of(scratch_path(spark, "ledger"), parts)
    fit = train._fit_trees

    def lost(*args):
        raise RuntimeError("the driver is lost here")

    monkeypatch.setattr(train, "_fit_trees", lost)
    with pytest.raises(RuntimeError):
        train.train_model("rf", parts, [CONFIG], FOREST, ledger=ledger)
    monkeypatch.setattr(train, "_fit_trees", fit)
    monkeypatch.setitem(train.SEARCHES, "rf", lost)
    model = train.train_model("rf", parts, [CONFIG], FOREST, ledger=ledger)
    assert model.params in FOREST and 0 <= model.cv_f1 <= 1
    monkeypatch.setattr(train, "_fit_trees", lost)
    assert train.train_model("rf", parts, [CONFIG], FOREST, ledger=ledger).params == model.params


def test_fingerprints_follow_the_mails(parts):
    same = fingerprint(parts.repartition(5, "text"))
    assert same == fingerprint(parts)
    assert fingerprint(parts.where("id <> 'm3'")) != same
    assert fingerprint(parts.withColumn("label", 1 - F.col("label"))) != same
    assert fingerprint(parts.unionByName(parts)) != same
