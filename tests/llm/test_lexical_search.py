import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from mailspark.llm import lexical_search
from mailspark.llm.lexical_search import (
    Best,
    Block,
    bounds,
    coordinates,
    index,
    rank_documents,
    rescore,
    search,
)
from mailspark.sources.scratch import written
from tests.llm.helpers import EDGE, empty, table

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])
QUERIES = [
    (1, "The quick FOX fox"),
    (2, "lorem ipsum 日本語 É é"),
    (3, None),
    (4, " ,;"),
    (5, "unheard-of"),
    (6, "endoftext s 12"),
    (6, "dog dog dog another id"),
]


def plain(docs, queries, k=20):
    """Every query against every document."""
    counts = [(i, Counter(TERMS.findall((t or "").translate(LOWER)))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    total = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    found = []
    for item, text in queries:
        terms = TERMS.findall((text or "").translate(LOWER))
        rows = []
        for i, c in counts:
            m = 75 + 25 * sum(c.values()) * len(counts) // total
            score = sum(
                math.floor(1000 * math.log((2 * len(counts) + 2) / (2 * df[t] + 1)))
                * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t in terms
                if t in c
            )
            if score > 0:
                rows.append((-score, i is None, i or 0, i))
        rows.sort()
        found += [(item, n + 1, r[3], -r[0]) for n, r in enumerate(rows[:k])]
    return sorted(found, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def items(spark, rows=QUERIES):
    return spark.createDataFrame(rows, ITEMS)


@pytest.mark.parametrize("k", [1, 3, 20])
def test_edge_rows(spark, k):
    docs = table(spark, EDGE)
    assert rows_of(rank_documents(docs, items(spark), k)) == plain(EDGE, QUERIES, k)


def test_whole_table_in_blocks_and_narrow_sketches(spark, monkeypatch):
    """Few coordinates make poor bounds, which cost time but change nothing."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    queries = spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text")
    expected = plain([tuple(r) for r in docs.collect()], [tuple(r) for r in queries.collect()])
    assert rows_of(rank_documents(docs, queries)) == expected
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", 300)
    monkeypatch.setattr(lexical_search, "TERMS_AT_ONCE", 100)
    narrow = written(index(docs.repartition(5), width=16), "narrow-index")
    assert rows_of(search(narrow, queries, width=16)) == expected


def test_many_equal_scores_go_by_id(spark):
    docs = [(100 - i, "same words here") for i in range(60)] + [(None, "same words here")]
    found = rows_of(rank_documents(table(spark, docs), items(spark, [(1, "words")]), 5))
    assert [r[2] for r in sorted(found, key=lambda r: r[1])] == [41, 42, 43, 44, 45]


def test_bounds_hold_and_stop_the_search():
    rng = np.random.default_rng(5)
    width, docs, vocabulary = 8, 200, 40
    names = [f"t{i}".encode() for i in range(vocabulary)]
    places = coordinates(names, width)
    values = np.where(rng.random((docs, vocabulary)) < 0.15, rng.integers(1, 10**6, (docs, vocabulary)), 0)
    sketches = np.zeros((width, docs), np.int64)
    for t in range(vocabulary):
        sketches[places[t]] = np.maximum(sketches[places[t]], values[:, t])
    terms = np.array([3, 7, 11, 20, 5])
    weights = np.array([5, 1, 9, 2, 4])
    block = Block([0, 1], {}, np.array([0, 3]), terms, weights, places[terms])
    upper = bounds(block, sketches, 0, 2)
    for q, run in enumerate((slice(0, 3), slice(3, 5))):
        exact = (values[:, terms[run]] * weights[run]).sum(axis=1)
        assert (upper[q] >= exact).all()
        best = Best(10)
        scored = rescore(block, q, upper[q], list(range(docs)), lambda _, d: int(exact[d]), best)
        expected = sorted(((s, -d) for d, s in enumerate(exact.tolist()) if s > 0), reverse=True)[:10]
        assert sorted(best.heap, reverse=True) == expected
        assert scored < docs


def test_empty_tables(spark):
    assert rank_documents(empty(spark), items(spark)).count() == 0
    assert rank_documents(table(spark, EDGE), items(spark, [])).count() == 0
    assert rank_documents(table(spark, [(1, None), (2, "")]), items(spark)).count() == 0
