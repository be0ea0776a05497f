import hashlib
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from mailspark.llm import exact_dedup
from mailspark.llm.exact_dedup import block_key, exact_duplicates, identities
from tests.llm.helpers import EDGE, empty, table

LAST = 1 << 63


def brute(documents):
    groups = defaultdict(list)
    for i, t in documents:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    found = []
    for text, ids in groups.items():
        first = min(ids, key=lambda i: LAST if i is None else i)
        digest = hashlib.sha256(text.encode()).hexdigest()
        kept = ids.index(first)
        found += [(i, first, len(ids), n == kept, digest) for n, i in enumerate(ids)]
    return sorted(found, key=repr)


def rows(df):
    names = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def test_edge_rows(spark):
    assert rows(exact_duplicates(table(spark, EDGE))) == brute(EDGE)


def test_empty_table(spark):
    assert exact_duplicates(empty(spark)).collect() == []


def test_many_levels_of_small_blocks(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 40))) for _ in range(60)]
    documents = [(i, rng.choice(texts)) for i in range(200)]
    assert rows(exact_duplicates(table(spark, documents), size=3)) == brute(documents)


def test_keys_that_collide_are_drawn_again(spark):
    tried = []

    def weak_at_first(block, seed):
        if seed not in tried:
            tried.append(seed)
        if seed == 0:
            return F.struct(F.length(block).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
        return block_key(block, seed)

    documents = [(i, t) for i, t in enumerate(["aa", "bb", "aa", "cc", "c", ""])]
    found = identities(table(spark, documents).select("doc_id", "text"), key=weak_at_first)
    names = {r.doc_id: (r.levels, r.name) for r in found.collect()}
    assert tried == [0, 2]
    assert names[0] == names[2] and len(set(names.values())) == 5


def test_carried_columns(spark):
    docs = table(spark, EDGE).withColumn("mark", F.lit("m"))
    assert {r.mark for r in exact_duplicates(docs, carry=("mark",)).collect()} == {"m"}


def test_block_size_is_a_parameter():
    assert exact_dedup.BLOCK == 4096


def test_names_do_not_depend_on_the_layout(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice("abc") for _ in range(rng.randint(0, 30))) for _ in range(80)]
    documents = [(i, rng.choice(texts)) for i in range(240)]
    found = []
    for parts in (1, 7):
        docs = table(spark, documents).select("doc_id", "text").repartition(parts)
        rows = identities(docs, 3).collect()
        found.append({r.doc_id: (r.levels, r.name) for r in rows})
    assert found[0] == found[1]
    singles = {t: found[0][i] for i, t in documents if 0 < len(t) <= 3}
    assert sorted(n for _, n in singles.values()) == sorted({n for _, n in singles.values()})


def test_ranks_are_gapless_and_sorted(spark):
    rows = spark.range(1000).selectExpr("1000 - id AS v", "id % 7 AS w").repartition(5)
    found = {r.v: r.name for r in exact_dedup.ranked(rows, "v").collect()}
    assert found == {v: v - 1 for v in range(1, 1001)}
