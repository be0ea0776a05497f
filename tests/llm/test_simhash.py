import random
import re

import numpy as np
import xxhash

from mailspark.llm.components import components
from mailspark.llm.simhash import BITS, bucket_links, fingerprint, flips, forest, near_duplicates
from tests.llm.helpers import EDGE, LONG, empty, table


def brute_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    counts = [0] * BITS
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(BITS):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(BITS) if 2 * counts[b] > len(shingles))


def brute_roots(values):
    parent = list(range(len(values)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= 3:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(values))]


def test_fingerprints():
    for text in ["", "one", "one two", "A b C d", "x " * 50, LONG[:3000], "é ü x y z"]:
        assert fingerprint(text) == brute_fingerprint(text)


def test_long_texts_are_read_in_parts(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(5000))
    whole = fingerprint(text)
    monkeypatch.setattr("mailspark.llm.simhash.word_chunks.__defaults__", (100,))
    assert fingerprint(text) == whole == brute_fingerprint(text)


def test_edge_rows(spark):
    found = near_duplicates(table(spark, EDGE)).collect()
    values = [brute_fingerprint(t) for _, t in EDGE]
    roots = brute_roots(values)
    expected = []
    for (i, _), value, root in zip(EDGE, values, roots):
        ids = [EDGE[k][0] for k, r in enumerate(roots) if r == root and EDGE[k][0] is not None]
        expected.append((i, f"{value:016x}", min(ids, default=None)))
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_empty_table(spark):
    assert near_duplicates(empty(spark)).collect() == []


def test_all_pairs_within_three_bits_meet():
    rng = np.random.default_rng(4)
    centres = rng.integers(0, 1 << 63, 40, np.int64).astype(np.uint64)
    fps = [int(c) for c in centres]
    for c in centres.tolist():
        for n in range(7):
            bits = rng.choice(BITS, n, replace=False)
            fps.append(c ^ sum(1 << int(b) for b in bits))
    fps = np.unique(np.array(fps, np.uint64))
    bits = [3, 17, 29, 40, 63]
    mask = np.uint64(sum(1 << b for b in bits))
    a, b = [], []
    near = np.concatenate([flips(bits, 0), flips(bits, 1)])
    ball = np.concatenate([near, flips(bits, 2)])
    buckets = {}
    for f in fps:
        for move in ball if int(f).bit_count() % 2 == 0 else near:
            buckets.setdefault(int((f & mask) ^ move), []).append(f)
    for bucket, members in buckets.items():
        x, y = forest(*bucket_links(np.array(members, np.uint64), bucket, bits))
        a.append(x)
        b.append(y)
    x, y = forest(np.concatenate(a), np.concatenate(b))
    root = dict(zip(x.tolist(), y.tolist()))
    values = fps.tolist()
    expected = brute_roots(values)
    got = {}
    for v, r in zip(values, expected):
        got.setdefault(r, set()).add(root.get(v, v))
    assert all(len(s) == 1 for s in got.values())
    assert len(set().union(*got.values())) == len(got)


def test_components_of_paths_and_stars(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 150)]
    links += [(200, 200), (301, 300), (300, 301)]
    rng.shuffle(links)
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(41))
    assert all(found[i] == 100 for i in range(100, 150))
    assert found[301] == found[300] == 300 and 200 not in found


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
