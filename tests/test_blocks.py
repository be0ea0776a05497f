"""Mails in blocks against the long tables, and mail folders without a folder a mail."""

import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mailspark import queries
from mailspark.config import CHAR_3_5, WORD_1_2
from mailspark.functions.terms import char_ngrams, ngrams_of_word
from mailspark.operators import blocks, naive_bayes
from mailspark.operators.explain import token_contributions
from mailspark.operators.features import linear_sums, prepared_terms, term_counts, tfidf
from mailspark.plans import train

CONFIG = WORD_1_2.with_changes(min_df=1, max_df=1.0, stop_words=())
ROWS = [
    (f"m{i % 37}" if i else None, i % 2, None if i % 5 == 0 else i % 37 % 3, f"win{i % 4} cash lunch{i % 7} " * (i % 4))
    for i in range(40)
]


@pytest.fixture
def mails(spark):
    return spark.createDataFrame(ROWS, "id string, label int, fold int, text string").repartition(3)


@pytest.mark.parametrize("cells", [1, 20, 1000])
def test_blocks_hold_every_cell_once(mails, monkeypatch, cells):
    monkeypatch.setattr(blocks, "CELLS_PER_BLOCK", cells)
    found = blocks.mail_blocks(mails, CONFIG)
    assert found.mails.count() == len(ROWS)
    per_block = found.terms.groupBy("block").agg(F.count("*").alias("n"), F.countDistinct("token").alias("d"))
    assert per_block.where("n != d").count() == 0
    sums = found.terms.groupBy("token").agg(F.sum("df").alias("df"))
    counted = term_counts(prepared_terms(mails, CONFIG)).groupBy("token").agg(F.count("*").alias("df"))
    assert sorted(map(tuple, sums.collect())) == sorted(map(tuple, counted.collect()))


def test_sums_and_contributions_are_those_of_the_tables(spark, mails):
    unique = mails.dropDuplicates(["id"]).where("id is not null")
    docs = prepared_terms(unique, CONFIG)
    table = term_counts(docs).groupBy("token").agg(F.count("*").alias("df")).where("df < 9").select(
        "token", (F.lit(1.0) / F.col("df")).alias("idf"), (F.col("df") - 4.0).alias("weight"))
    coded = blocks.mail_blocks(unique, CONFIG)
    weights = {"dot": F.col("weight")}
    old = {r["id"]: r["dot"] for r in linear_sums(docs, table, F.col("idf"), weights, CONFIG).collect()}
    new = {r["id"]: r["dot"] for r in blocks.block_sums(coded, table, F.col("idf"), weights, CONFIG).collect()}
    assert new == pytest.approx(old)
    every = {}
    for r in tfidf(docs.select("id", "terms"), table.withColumnRenamed("weight", "c"), CONFIG, ("c",)).collect():
        every.setdefault(r["id"], []).append((round(r["weight"] * r["c"], 9), r["token"]))
    found = {(r["id"], r["side"], r["place"]): r["token"] for r in token_contributions(coded, table, CONFIG, 2).collect()}
    for name, cells in every.items():
        for side, sign in (("spam", -1), ("ham", 1)):
            best = [t for _, t in sorted((sign * x, t) for x, t in cells)][:2]
            assert [found[name, side, i + 1] for i in range(len(best))] == best


def test_rows_that_share_an_id_count_as_one_mail(spark):
    rows = [("a", 0, None, "x y"), ("a", 0, None, "x y"), ("b", 1, None, "")]
    coded = blocks.mail_blocks(spark.createDataFrame(rows, "id string, label int, fold int, text string"), CONFIG)
    table = spark.createDataFrame([("x", 1.0, 1.0)], "token string, idf double, weight double")
    sums = blocks.block_sums(coded, table, F.col("idf"), {"dot": F.col("weight")}, CONFIG).collect()
    assert {r["id"]: r["dot"] for r in sums} == pytest.approx({"a": 2**0.5, "b": 0.0}) and len(sums) == 2


def test_naive_bayes_shuffles_no_term_by_mail(mails):
    """Rows with a token were shuffled with the id of every mail that holds it."""
    known = mails.withColumn("label", F.coalesce("label", F.lit(0))).where("id is not null")
    model = naive_bayes.fit(blocks.mail_blocks(known, CONFIG), CONFIG, (0.1,), None)
    plan = naive_bayes.score(model, model.blocks)._jdf.queryExecution().executedPlan().toString()
    exchanged = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert "FlatMapCoGroupsInArrow" in plan and not any("hashpartitioning(id" in line for line in exchanged)


def test_mail_folders_have_no_folder_a_mail(spark):
    """every mail had a folder of its own, and few tasks wrote them all."""
    base = queries.mail_folders(spark, "/root/testdata/sf0.001").removeprefix("file:")
    mails = queries.labelled_documents(spark, "/root/testdata/sf0.001")
    for name in ("ham", "spam"):
        found = [e for e in os.scandir(f"{base}/{name}") if not e.name.startswith(("_", "."))]
        assert all(e.is_file() for e in found)
        filled = sum(e.stat().st_size > 0 for e in found)
        assert filled == mails.where(F.col("label_name") == name).count()


def test_naive_bayes_shuffles_numbers_of_terms(mails):
    """Every shuffle after the first held the terms of each block as text again."""
    known = mails.withColumn("label", F.coalesce("label", F.lit(0))).where("id is not null")
    model = naive_bayes.fit(blocks.mail_blocks(known, CONFIG), CONFIG, (0.1,), None)
    plan = naive_bayes.score(model, model.blocks)._jdf.queryExecution().executedPlan().toString()
    assert "Join [token" not in plan and "Join [term_" in plan
    other = naive_bayes.fit(blocks.mail_blocks(known, CONFIG), CONFIG, (0.1,), None)
    scores = [sorted(naive_bayes.score(model, b).select("id", "score").collect()) for b in (model.blocks, other.blocks)]
    assert scores[0] == scores[1]


def test_blocks_hold_mails_of_one_fold_and_are_few(spark):
    """Every task made a block for each fold."""
    rows = [(f"m{i}", i % 2, i % 4 or None, "a b c") for i in range(400)]
    found = blocks.mail_blocks(spark.createDataFrame(rows, "id string, label int, fold int, text string"), CONFIG)
    per_block = found.mails.groupBy("block").agg(F.countDistinct(F.coalesce("fold", F.lit(-1))).alias("n")).collect()
    assert all(r["n"] == 1 for r in per_block) and len(per_block) <= 8 + 3


def test_test_mails_are_scored_by_numbers_of_terms(mails):
    """All terms of the test mails were joined to the chosen model as text."""
    parts = mails.withColumn("label", F.coalesce("label", F.lit(0))).where("id is not null").dropDuplicates(["id"])
    terms = train.TermTables(parts)
    model = train.train_model("nb", parts, [CONFIG], [{"clf__alpha": 0.1}], terms=terms)
    coded = terms.blocks(CONFIG).where(F.col("fold").isNull())
    own = model.blocks.where(F.col("fold").isNull())
    plans = [model.score_blocks(b)._jdf.queryExecution().executedPlan().toString() for b in (own, coded)]
    assert "Join [term_" in plans[0] and "Join [token" in plans[1]
    by_number, by_token, scored = (
        sorted(map(tuple, rows.select("id", "score", "prediction").collect()))
        for rows in (model.score_blocks(own), model.score_blocks(coded), train.score_test(model, parts, terms))
    )
    assert by_number == by_token == scored and by_number


def test_dictionaries_are_counted_as_packed_shares(spark, mails, monkeypatch):
    """The shuffle that counts terms had a row of text for each term of each block."""
    more = spark.createDataFrame([("n0", 1, 0, "tiền lãi éé win1"), ("n1", 0, None, "tiền cash")], mails.schema)
    known = mails.unionByName(more).withColumn("label", F.coalesce("label", F.lit(0))).where("id is not null")
    plans, kept = {}, naive_bayes.written

    def seen(rows, name, **options):
        plans[name] = rows._jdf.queryExecution().executedPlan().toString()
        return kept(rows, name, **options)

    monkeypatch.setattr(naive_bayes, "written", seen)
    tables = []
    for shares in (1, 300):
        monkeypatch.setattr(blocks, "SHARES", shares)
        coded = blocks.mail_blocks(known, CONFIG)
        assert coded.shares.agg(F.sum("n_terms")).first()[0] == coded.terms.count()
        sums = coded.terms.groupBy("token").agg(F.sum("df").alias("df"))
        counted = term_counts(prepared_terms(known, CONFIG)).groupBy("token").agg(F.count("*").alias("df"))
        assert sorted(map(tuple, sums.collect())) == sorted(map(tuple, counted.collect()))
        table = naive_bayes.fit(coded, CONFIG, (0.1,), 3).table
        tables.append(sorted(tuple(r) for r in table.select("token", "final_idf", "cv0_idf", F.round("cv1_1", 9)).collect()))
        assert "hashpartitioning(share" in plans["block-vocabulary"] and "hashpartitioning(token" not in plans["block-vocabulary"]
    assert tables[0] == tables[1] and any("tiền" in r[0] for r in tables[0])


@pytest.mark.parametrize("cells", [1, 60, 1000, 100_000])
def test_char_ngrams_of_words_cut_once_are_those_of_the_texts(spark, monkeypatch, cells):
    """Each n-gram of each mail was a string, sorted and counted in its row."""
    config = CHAR_3_5.with_changes(min_df=1)
    odd = ["a", "ab", None, "", "x" * 70 + " \U0001F600b \U0001F600", "\u0111\u00e2y " * 3, "b" * 64, "  tab\tand  blanks "]
    texts = odd + [f"win{i % 4} cash, cash lunch{i % 7} {'ab' * (i % 5)}" for i in range(30)]
    rows = [(f"m{i}" if i != 3 else None, i % 2, i % 4 if i % 4 < 3 else None, t) for i, t in enumerate(texts)]
    rows += [("m9", 0, 1, "win1 again"), ("m9", 0, 1, "win1 again")]
    mails = spark.createDataFrame(rows, "id string, label int, fold int, text string").repartition(3)
    monkeypatch.setattr(blocks, "CELLS_PER_BLOCK", cells)
    monkeypatch.setattr(blocks, "MAILS_AT_ONCE", 4)

    def of_texts(*_):
        raise AssertionError("n-grams of whole texts")

    with monkeypatch.context() as m:
        m.setattr(blocks, "term_documents", of_texts)
        found = blocks.mail_blocks(mails, config)
    assert found.mails.count() == len(rows)
    per_block = found.terms.groupBy("block").agg(F.count("*").alias("n"), F.countDistinct("token").alias("d"))
    assert per_block.where("n != d").count() == 0
    expected = prepared_terms(mails, config)
    sums = found.terms.groupBy("token").agg(F.sum("df").alias("df"))
    counted = term_counts(expected).groupBy("token").agg(F.count("*").alias("df"))
    assert sorted(map(tuple, sums.collect())) == sorted(map(tuple, counted.collect()))
    dictionary = {(r.block, r.code): r.token for r in found.terms.collect()}
    mailed = []
    for r in found.mails.collect():
        steps, tf = (np.frombuffer(pa.decompress(data, 4 * r.cells, "zstd", asbytes=True) if r.cells else b"", np.int32)
                     for data in (r.codes, r.counts))
        mailed.append((str(r.id), sorted((dictionary[r.block, c], int(n)) for c, n in zip(np.cumsum(steps).tolist(), tf))))
    assert sorted(mailed) == sorted((str(r.id), sorted((t.token, t.tf) for t in r.terms)) for r in expected.collect())


@pytest.mark.parametrize("word", ["a", "ab", "abc", "abcdef", "\U0001F600x", "y" * 70])
def test_ngrams_of_a_word(spark, word):
    row = spark.createDataFrame([(word,)], "w string").select(char_ngrams(F.col("w"), 3, 5).alias("g")).first()
    assert row.g == ngrams_of_word(word, 3, 5)
