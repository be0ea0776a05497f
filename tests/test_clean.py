"""Cleaning: golden strings by hand, and properties."""

import unicodedata
from itertools import product

from pyspark.sql import functions as F

from mailspark.functions import clean

GOLDEN = {
    "From: a@b.c\r\nhi http://x.y/z $ 5,000.5 !!!!! 12.5 a1 1a a_1 <b>x</b>": (
        "hi urltoken moneytoken . numtoken !!! numtoken a1 1a a_1 x"
    ),
    "subject : re\rTo: q\nz": "subject : re z",
    "tiền 10%/tháng 100.000.000 đ": "tiền numtoken %/tháng numtoken . numtoken đ",
    "A" * 41 + "==": "",
    "x from: y": "x from: y",
    '<a href="http://x.y">click</a> b > c': "c",
    "1é 100.000.000đ": "1é numtoken .000đ",
    "é@b.co www.x.y": "emailtoken urltoken",
    "５００ ﬁne": "numtoken fine",
    "a 　b\x1cc d": "a b c d",
    "??? !!!! $$ ok": "??? !!! $$ ok",
    "€5 £ 7.25 $": "moneytoken moneytoken $",
    "": "",
    "  ": "",
    "é 1é": "é 1é",
    "Ngày 12/3 CC: ai": "ngày numtoken / numtoken cc: ai",
    "a-b.c@d-e.f.g!": "emailtoken !",
    "x" * 39 + " " + "y" * 40: "x" * 39,
}


def test_golden(spark):
    df = spark.createDataFrame([(t,) for t in GOLDEN], "text string")
    found = {r["text"]: r["clean"] for r in clean.clean_text(df).collect()}
    assert found == GOLDEN


def test_null_becomes_empty_and_filters_do_not_blow_up(spark):
    df = spark.createDataFrame([(None,), ("A b",)], "text string")
    out = clean.clean_text(df).where("clean <> ''").where(F.length("clean") > 0)
    assert [r["clean"] for r in out.collect()] == ["a b"]
    assert len(out._jdf.queryExecution().optimizedPlan().toString()) < 100_000


def test_no_url_is_left(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    cleaned = clean.clean_text(documents, "html")
    assert cleaned.where(F.col("clean").rlike("https?://[^ ]")).count() == 0


def test_stable_characters_never_change():
    stable = [chr(c) for low, high in clean.NFKC_STABLE for c in range(low, high + 1)]
    assert all(clean.is_nfkc_stable(ch) for ch in stable)
    for ch in stable:
        assert unicodedata.normalize("NFKC", ch) == ch
    some = stable[::3]
    for a, b in product(some, some):
        assert unicodedata.normalize("NFKC", a + b) == a + b
    assert not any(map(clean.is_nfkc_stable, "５ﬁ́½² "))
