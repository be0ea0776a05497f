import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from mailspark.llm.spelling import (
    PositionIndex,
    forms,
    letter_codes,
    near_words,
    spelling_variants,
    with_roots,
    word_counts,
)
from tests.llm.helpers import EDGE, empty, table

RUNS = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_counts(docs, letters=7):
    counts = Counter()
    for doc_id, text in docs:
        for run in RUNS.findall(text or ""):
            run = run.translate(LOWER)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1 :]
            if len(run) >= letters:
                counts[run] += 1
    return counts


def plain(counts):
    """Every word against every other."""
    near = {w: [v for v in counts if one_apart(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda v: (-counts[v], v))
            if counts[best] >= 10 * counts[w]:
                form[w] = best
    rows = []
    for w in counts:
        root = w
        while root in form:
            root = form[root]
        rows.append((w, form.get(w), root, counts[w], len(near[w]), counts.get(form.get(w))))
    return sorted(rows, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_near_words_against_all_pairs():
    rng = np.random.default_rng(1)
    words = sorted({bytes(rng.choice(list(b"ab\xe9"), rng.integers(1, 7)).tolist()) for _ in range(300)})
    for length in range(1, 7):
        index = PositionIndex(words, 7)
        queries = [w for w in words if len(w) == length]
        near, agreeing = near_words(index, letter_codes(queries, length), 2)
        for q, bits, same in zip(queries, near, agreeing):
            found = np.unpackbits(bits.view(np.uint8), bitorder="little")[: len(words)]
            assert [bool(x) for x in found] == [one_apart(q, w) for w in words]
            if length >= 2:
                halves = np.unpackbits(same.view(np.uint8), bitorder="little")[: len(words)]
                assert [bool(x) for x in halves] == [w[:2] == q[:2] for w in words]


@pytest.mark.parametrize("size", [1, 3, 4096])
def test_forms_against_all_pairs(spark, size):
    """Small shards deal the words of one key to many blocks."""
    rng = np.random.default_rng(2)
    words = {}
    for _ in range(400):
        word = "".join(rng.choice(list("abé"), rng.integers(3, 9)))
        words[word] = int(10 ** rng.uniform(0.4, 4))
    found = forms(spark.createDataFrame(list(words.items()), "word string, n long"), 3, size)
    assert rows_of(with_roots(found).select("word", "form", "root", "n", "n_near", "form_n")) == [
        r for r in plain({w: n for w, n in words.items()})
    ]


def test_chains_end_at_their_last_form(spark):
    words = [("abcdefg" + "x" * i, 3 * 10**i) for i in range(9)]
    rows = with_roots(forms(spark.createDataFrame(words, "word string, n long"))).collect()
    assert {r.root for r in rows} == {words[-1][0]}
    assert {r.word: r.form for r in rows} == {
        w: words[i + 1][0] if i < 8 else None for i, (w, _) in enumerate(words)
    }


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    counts = {w: n for w, n in plain_counts([tuple(r) for r in docs.collect()]).items() if n >= 2}
    assert len(counts) > 200
    assert rows_of(spelling_variants(docs)) == plain(counts)


def test_edge_rows(spark):
    more = [(9, "Straße straßen ×÷ÀÀÀÀÀ Übermut übermut"), (10, "wonderful " * 30 + "wonderfull wonderfull")]
    docs = EDGE + more
    counts = {w: n for w, n in plain_counts(docs, 4).items() if n >= 2}
    assert rows_of(spelling_variants(table(spark, EDGE, more=more), letters=4)) == plain(counts)
    assert {r.word: r.n for r in word_counts(table(spark, docs)).collect()} == plain_counts(docs)


def test_a_very_long_word(spark):
    docs = [(1, "a" * 20_000), (2, "a" * 20_000), (3, "a" * 19_999), (4, "a" * 19_999)]
    rows = rows_of(spelling_variants(table(spark, docs)))
    assert rows and all(r[4] == len(rows) - 1 for r in rows)


def test_empty_table(spark):
    assert spelling_variants(empty(spark)).count() == 0
