import struct
from collections import defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from mailspark.llm.language import UNKNOWN, language_model, verdicts
from mailspark.llm.secret_scan import MASK
from tests.llm.helpers import EDGE, empty, table
from tests.llm.test_exact_dedup import brute as brute_copies
from tests.llm.test_secret_scan import TEXTS
from tests.llm.test_simhash import brute_fingerprint, brute_roots

FOLDER = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def stage(spark, name, docs, tmp_path):
    path = str(tmp_path / name)
    STAGES[name](spark, docs, FOLDER).write.parquet(path)
    return spark.read.parquet(path)


def test_names_and_order():
    assert list(STAGES) == ["language", "exact_dedup", "near_dedup", "secrets", "packing"]


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = language_model(docs)
    spoken = stage(spark, "language", docs, tmp_path)
    rows = docs.collect()
    found = zip(rows, verdicts(model, [r.text or "" for r in rows]))
    expected = {r.doc_id: lang for r, (lang, _, _) in found if lang != UNKNOWN}
    assert {r.doc_id: r.lang for r in spoken.collect()} == expected
    single = stage(spark, "exact_dedup", spoken, tmp_path)
    rows = spoken.collect()
    kept = {r[0] for r in brute_copies([(r.doc_id, r.text) for r in rows]) if r[3]}
    assert {r.doc_id for r in single.collect()} == kept
    apart = stage(spark, "near_dedup", single, tmp_path)
    rows = sorted(single.collect(), key=lambda r: r.doc_id)
    roots = brute_roots([brute_fingerprint(r.text) for r in rows])
    assert {r.doc_id for r in apart.collect()} == {rows[i].doc_id for i in set(roots)}
    masked = stage(spark, "secrets", apart, tmp_path)
    assert masked.columns == docs.columns and masked.count() == apart.count()
    before = {r.doc_id: r for r in apart.collect()}
    for r in masked.collect():
        if MASK in r.text:
            assert r.n_chars == len(r.text)
        else:
            assert r == before[r.doc_id]
    pieces = stage(spark, "packing", masked, tmp_path).collect()
    known = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
    for r in masked.collect():
        ids = [*known.encode(r.text, add_special_tokens=False).ids, 0]
        data = b"".join(p.ids for p in sorted(by_doc.pop(r.doc_id), key=lambda p: p.start))
        assert data == struct.pack(f"<{len(ids)}I", *ids)
    assert not by_doc
    # The whole run gives the same pieces of the same documents.
    again = corpus_pipeline.run(spark, FOLDER).collect()
    assert sum(p.length for p in again) == sum(p.length for p in pieces)
    assert {p.doc_id for p in again} == {p.doc_id for p in pieces}


@pytest.mark.parametrize("name", ["language", "exact_dedup", "near_dedup", "secrets"])
def test_edge_rows(spark, tmp_path, name):
    docs = table(spark, EDGE, more=[(1, TEXTS[0]), (None, TEXTS[0]), (20, TEXTS[3])])
    found = stage(spark, name, docs, tmp_path)
    assert found.columns == docs.columns
    rows = found.collect()
    ids = {r.doc_id for r in rows}
    if name == "language":
        assert not ids & {2, 3, 4} and {1, 5, 6, 20} <= ids
    elif name == "secrets":
        assert len(rows) == docs.count()
    else:
        # One of each: repeated rows, copies under other ids, the blank ones.
        assert sum(r.text == EDGE[0][1] for r in rows) == 1
        assert {5, 20} <= ids and 6 not in ids and 3 not in ids
        assert sum(r.doc_id == 2 for r in rows) == 1


@pytest.mark.parametrize("name", list(STAGES))
def test_empty_table(spark, tmp_path, name):
    assert stage(spark, name, empty(spark), tmp_path).count() == 0


def test_rows_that_repeat_the_id_but_not_the_text(spark, tmp_path):
    docs = table(spark, [(1, "one text here"), (1, "quite another one"), (1, "one text here")])
    found = stage(spark, "exact_dedup", docs, tmp_path)
    assert sorted(r.text for r in found.select(F.col("text")).collect()) == [
        "one text here",
        "quite another one",
    ]


def test_the_language_found_replaces_the_label(spark, tmp_path):
    words = {"aa": "abcde fabec", "bb": "ghijk lkjig"}
    rows = [(i, f"{w} " * 20, k) for i in range(40) for k, w in words.items()]
    odd = [(100, "ghijk lkjig " * 9, "aa"), (101, "abcde " * 9, None), (102, "12:30 -- 7", "bb"), (103, "", "aa")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")
    found = stage(spark, "language", docs, tmp_path)
    kept = {r.doc_id: r.lang for r in found.where("doc_id >= 100").collect()}
    assert kept == {100: "bb", 101: "aa"} and found.count() == len(rows) + 2
    text = STAGES["language"](spark, docs, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert text.count("ArrowEvalPython") == 1


def test_mixed_texts_stay_and_so_do_all_without_labels(spark, tmp_path):
    words = {"aa": "abcde", "bb": "fghij", "cc": "klmno"}
    rows = [(i, " ".join([w] * 30), k) for i in range(60) for k, w in words.items()]
    mixed = " ".join([words["aa"]] * 40 + [words["bb"]] * 35 + [words["cc"]] * 25)
    docs = spark.createDataFrame(
        [*rows, (100, mixed, None), (101, "12 34", None)], "doc_id long, text string, lang string"
    )
    score = verdicts(language_model(docs), [mixed])[0][1]
    assert 0 < score < 0.5
    kept = {r.doc_id: r.lang for r in stage(spark, "language", docs, tmp_path).collect()}
    assert kept[100] == "aa" and 101 not in kept
    bare = docs.withColumn("lang", F.lit(None).cast("string"))
    assert STAGES["language"](spark, bare, FOLDER).count() == len(rows) + 1
