"""Models: scores from tables equal the solvers' own, saved equals loaded."""

import pytest
from pyspark.sql import functions as F

from mailspark.config import WORD_1_2
from mailspark.operators.classifiers import GRIDS, linear_point
from mailspark.operators.explain import token_contributions, top_tokens
from mailspark.operators.features import linear_sums, prepared_terms
from mailspark.plans import train
from mailspark.plans.evaluate import default_threshold, evaluate, predict
from mailspark.plans.model import load_model, save_model
from mailspark.sources.mails import load_mails
from mailspark.sources.scratch import scratch_path, written

CONFIG = WORD_1_2.with_changes(max_n=1)
SPAM_WORDS, HAM_WORDS = ("win", "cash", "prize"), ("meeting", "report", "lunch")


@pytest.fixture(scope="module")
def parts(spark):
    rows = []
    for i in range(60):
        spam = i % 3 == 0
        words = SPAM_WORDS if spam else HAM_WORDS
        text = " ".join(words[(i + k) % 3] for k in range(1 + i % 4)) + (" hello" if i % 5 else "")
        rows.append((f"m{i}", int(spam), text, f"p/{i}"))
    mails = spark.createDataFrame(rows, "id string, label int, text string, path string")
    return train.split_mails(mails.withColumn("label_name", F.lit("")))


def test_unknown_model(parts):
    with pytest.raises(ValueError):
        train.train_model("tree", parts)
    with pytest.raises(ValueError):
        linear_point("tree", {})


def test_grids_have_the_documented_sizes():
    assert {k: len(v) for k, v in GRIDS.items()} == {"svm": 4, "lr": 6, "rf": 36, "xgb": 32}


@pytest.mark.parametrize("name", ["nb", "svm", "rf", "xgb"])
def test_train_save_load(spark, parts, name):
    grids = {
        "svm": [{"clf__C": 1.0}],
        "rf": [{"clf__n_estimators": 5, "clf__max_depth": None, "clf__min_samples_split": 5, "clf__max_features": "log2"}],
        "xgb": [{"clf__n_estimators": 3, "clf__max_depth": 3, "clf__learning_rate": 0.3, "clf__subsample": 1.0, "clf__colsample_bytree": 0.8}],
    }
    model = train.train_model(name, parts, [CONFIG], grids.get(name))
    path = scratch_path(spark, "model")
    save_model(model, path)
    again = load_model(spark, path)
    assert (again.name, again.params, again.config) == (name, model.params, CONFIG)
    test = parts.where("split = 'test'")
    before, after = (
        {r["id"]: (r["score"], r["prediction"]) for r in m.score(test).collect()}
        for m in (model, again)
    )
    assert before == after and len(before) == test.count()
    if name in ("nb", "svm"):
        truth = {r["id"]: r["label"] for r in test.collect()}
        right = sum(before[i][1] == truth[i] for i in truth)
        assert right >= len(truth) - 1
        spam_side = top_tokens(again.weights(), 2).where("side = 'spam'")
        assert {r["token"] for r in spam_side.collect()} <= set(SPAM_WORDS)
    else:
        with pytest.raises(ValueError):
            again.weights()


def test_evaluate_predict_and_explain(spark, parts):
    model = train.train_model("nb", parts, [CONFIG])
    test = parts.where("split = 'test'").select("id", "label", "path", "text")
    out = scratch_path(spark, "reports")
    reports = evaluate(model, test, out)
    row = reports["eval_metrics"].first()
    assert row["tn"] + row["fp"] + row["fn"] + row["tp"] == test.count()
    assert spark.read.csv(f"{out}/classification_report", header=True).count() == 5
    odd = spark.createDataFrame([("a", "win cash"), ("b", "zzz"), ("c", "")], "id string, text string")
    rows = {r["id"]: r for r in predict(model, odd, 0.5).collect()}
    assert rows["a"]["predicted_label"] == "spam" and rows["b"]["score"] == rows["c"]["score"]
    found = token_contributions(prepared_terms(odd, CONFIG), model.weights(), CONFIG, 1).collect()
    assert {r["id"] for r in found} == {"a"} and len(found) == 2


def test_train_all_ranks_and_saves(spark, parts):
    out = scratch_path(spark, "run")
    board, models, best = train.train_all(parts, ("nb",), out, configs={"nb": [CONFIG]})
    rows = board.collect()
    assert [r["model"] for r in rows][0] == "nb" and best == "nb"
    assert [r["f1_spam"] for r in rows] == sorted((r["f1_spam"] for r in rows), reverse=True)
    assert load_model(spark, f"{out}/models/best_model").params == models["nb"].params
    saved = spark.read.parquet(f"{out}/train").count() + spark.read.parquet(f"{out}/test").count()
    assert saved == parts.count() == spark.read.parquet(f"{out}/emails_raw").count()


def test_folds_must_be_those_of_the_mails(parts):
    for name in ("nb", "lr"):
        with pytest.raises(ValueError, match="folds"):
            train.train_model(name, parts, [CONFIG], folds=5)


@pytest.mark.parametrize("name, params", [
    ("rf", {"clf__n_estimators": 5, "clf__max_depth": 10, "clf__min_samples_split": 2, "clf__max_features": "sqrt"}),
    ("xgb", {"clf__n_estimators": 3, "clf__max_depth": 3, "clf__learning_rate": 0.3, "clf__subsample": 0.8, "clf__colsample_bytree": 0.8}),
])
def test_fits_do_not_depend_on_the_layout(parts, name, params):
    scores = []
    for n in (1, 4):
        model = train.fit_model(name, parts.repartition(n, "text"), params, CONFIG)
        rows = model.score(parts.select("id", "text"), keep_text=False).collect()
        scores.append({r["id"]: r["score"] for r in rows})
    assert scores[0] == scores[1]


def test_scoring_reads_and_parses_mails_once(spark, parts, tmp_path):
    for label in ("ham", "spam"):
        (tmp_path / label).mkdir()
        (tmp_path / label / "a.eml").write_bytes(b"Subject: hi\n\nwin cash now")
    model = train.train_model("nb", parts, [CONFIG])
    mails = load_mails(spark, str(tmp_path)).drop("label_name")
    plan = model.score(mails, keep_text=False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInPandas") == 2  # one for each folder
    assert len(model.score(mails, keep_text=False).collect()) == 2


def test_default_thresholds(spark, parts):
    odd = spark.createDataFrame([("a", "win cash"), ("b", "lunch")], "id string, text string")
    model = train.train_model("nb", parts, [CONFIG])
    assert default_threshold(model) == 0.5
    rows = predict(model, odd, "default").collect()
    assert all((r["score"] >= 0.5) == (r["prediction"] == 1) for r in rows)
    assert not any(r["low_confidence"] for r in predict(model, odd).collect())


def test_a_hot_token_is_split(spark, parts):
    rows = [(f"h{i}", i % 2, "win " + "word%d" % i) for i in range(4000)]
    mails = spark.createDataFrame(rows, "id string, label int, text string").repartition(8)
    docs = written(mails.withColumn("terms", F.array(
        F.struct(F.lit("win").alias("token"), F.lit(1).alias("tf")),
        F.struct(F.concat(F.lit("w"), "id").alias("token"), F.lit(1).alias("tf")),
    )).drop("text"), "hot")
    table = written(docs.select(F.explode("terms.token").alias("token")).distinct().select(
        "token", F.lit(1.0).alias("idf"), F.lit(1.0).alias("weight")), "weights")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        sums = linear_sums(docs, table, F.col("idf"), {"dot": F.col("weight")}, CONFIG)
        assert sums.count() == 4000
        found = sums.select(F.min("dot"), F.max("dot"))
        sums.write.format("noop").mode("overwrite").save()
        low, high = found.first()
        assert low == pytest.approx(high) and "skew" in joined_plan(sums)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def joined_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
