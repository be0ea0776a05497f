"""Readers, sinks and the stream over files in a temporary folder."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from mailspark.config import ENGLISH_STOP_WORDS
from mailspark.operators.baselines import keyword_predictions
from mailspark.operators.split import parse_preview
from mailspark.sources.mails import labelled_frame, load_mails
from mailspark.sources.reports import read_report, save_table
from mailspark.sources.stop_words import read_stop_words, stop_words
from mailspark.streaming.score import mail_file_stream, score_stream

FILES = {
    "ham/a_first.txt": b"Subject: hello\n\nsee you at noon",
    "ham/deep/mail_1.txt": "chào cô".encode(),
    "ham/empty.txt": b"",
    "ham/copy.txt": b"Subject: hello\n\nsee you at noon",
    "spam/mail_2.txt": b"Subject: FREE\n\nclick now",
    "spam/same.txt": "chào cô".encode(),
}


@pytest.fixture
def corpus(tmp_path):
    for name, content in FILES.items():
        path = tmp_path / "ham in name" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)
    return str(tmp_path / "ham in name")


def short(rows):
    return sorted((r["label_name"], r["path"].rsplit("/", 1)[1], r["text"]) for r in rows)


def test_folders(spark, corpus):
    rows = load_mails(spark, corpus).collect()
    assert short(rows) == [
        ("ham", "a_first.txt", "hello\nsee you at noon"),
        ("ham", "copy.txt", "hello\nsee you at noon"),
        ("ham", "mail_1.txt", "chào cô"),
        ("spam", "mail_2.txt", "FREE\nclick now"),
        ("spam", "same.txt", "chào cô"),
    ]
    assert len({r["id"] for r in rows}) == 5
    assert {r["label"] for r in rows if r["label_name"] == "spam"} == {1}


def test_folders_dedup_and_limit(spark, corpus):
    once = load_mails(spark, corpus, dedup=True).collect()
    assert [r[:2] for r in short(once)] == [
        ("ham", "a_first.txt"), ("ham", "mail_1.txt"), ("spam", "mail_2.txt"),
    ]
    assert load_mails(spark, corpus, limit=4).where("label = 1").count() == 1
    assert load_mails(spark, corpus, limit=0).count() == 5


def test_delimited_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('text,label\n"x, ""y""\nz",1\nsame,0\nsame,0\n,0\n')
    rows = load_mails(spark, str(tmp_path / "a.csv")).collect()
    assert sorted((r["text"], r["label"]) for r in rows) == [("same", 0), ("same", 0), ('x, "y"\nz', 1)]
    assert len({r["id"] for r in rows}) == 3
    assert load_mails(spark, str(tmp_path / "a.csv"), dedup=True).count() == 2
    (tmp_path / "b.tsv").write_text("raw_text\tlabel\na,b\t1\n")
    row = load_mails(spark, str(tmp_path / "b.tsv")).first()
    assert (row["text"], row["label"], row["label_name"]) == ("a,b", 1, "spam")


def test_wrong_inputs(spark, tmp_path):
    with pytest.raises(ValueError):
        load_mails(spark, str(tmp_path))
    for name, head in (("c.csv", "body,label"), ("d.csv", "text,y")):
        (tmp_path / name).write_text(f"{head}\na,1\n")
        with pytest.raises(ValueError):
            load_mails(spark, str(tmp_path / name))


def test_reports(spark, tmp_path):
    table = spark.createDataFrame([("a\n\"b\"", 0.5), (None, None)], "t string, x double")
    for kind in ("csv", "parquet"):
        save_table(table, f"{tmp_path}/{kind}", kind)
        found = read_report(spark, f"{tmp_path}/{kind}", table.schema, kind)
        assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, table.collect()), key=str)
    assert read_report(spark, f"{tmp_path}/none", table.schema).count() == 0


def test_stream_equals_batch(spark, corpus, tmp_path):
    out, progress = f"{tmp_path}/out", f"{tmp_path}/progress"
    for _ in range(2):  # a second run finds nothing new
        stream = mail_file_stream(spark, corpus)
        score_stream(stream, keyword_predictions, out, progress).awaitTermination()
    found = {r["id"]: r["prediction"] for r in spark.read.parquet(out).collect()}
    batch = keyword_predictions(load_mails(spark, corpus)).select("id", "prediction")
    assert found == {r["id"]: r["prediction"] for r in batch.collect()}
    assert spark.read.parquet(out).where(F.col("predicted_name") == "spam").count() == 1


@pytest.mark.parametrize("label", ["", "2", "abc", "-1"])
def test_labels_must_be_0_or_1(spark, tmp_path, label):
    (tmp_path / "a.csv").write_text(f"text,label\nfine,1\nodd,{label}\n")
    with pytest.raises(Exception, match="labels must be 0 or 1"):
        load_mails(spark, str(tmp_path / "a.csv")).collect()


def test_rows_without_text_need_no_label(spark):
    frame = spark.createDataFrame([("x", "1"), (None, None)], "text string, label string")
    assert [tuple(r) for r in labelled_frame(frame).collect()] == [("x", 1)]


def test_subjects_are_kept_and_previewed(spark, corpus):
    rows = {r["label"]: r["subject"] for r in parse_preview(load_mails(spark, corpus)).collect()}
    assert rows == {"ham": "hello", "spam": "FREE"}


def test_stop_word_lists(spark, tmp_path):
    path = tmp_path / "words.txt"
    path.write_bytes("\ufeff# remark\n\nlà\n  và \n#x\nthe\n".encode())
    assert read_stop_words(spark, str(path)) == ("là", "và", "the")
    assert read_stop_words(spark, str(tmp_path / "none.txt")) == ()
    assert set(stop_words(spark, str(path), english=False)) == {"the", "và", "là"}
    both = stop_words(spark, str(path))
    assert set(both) == {*ENGLISH_STOP_WORDS, "là", "và"} and list(both) == sorted(both)
    assert stop_words(spark, str(path), english=False, listed=False) == ()
    assert set(stop_words(spark)) == set(ENGLISH_STOP_WORDS)


def test_scratch_tables_can_be_cleared(tmp_path):
    code = (
        "from pyspark.sql import SparkSession\n"
        "from mailspark.sources.scratch import written\n"
        "spark = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false')"
        f".config('spark.checkpoint.dir', '{tmp_path}').getOrCreate()\n"
        "assert written(spark.range(3), 'some').count() == 3\n"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
    assert not list(tmp_path.rglob("*.parquet"))
