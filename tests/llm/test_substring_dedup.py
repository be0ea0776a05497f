import hashlib
import random

import numpy as np
import pytest

from mailspark.llm import substring_dedup
from mailspark.llm.fm_index import FMIndex
from mailspark.llm.substring_dedup import repeated_passages, segments, shard_ranges
from tests.llm.helpers import EDGE, empty, table

LAST = 1 << 63


def brute(documents, window):
    words = [(t or "").encode().split() for _, t in documents]
    order = [LAST if i is None else i for i, _ in documents]
    first = {}
    for ws, o in zip(words, order):
        for i in range(len(ws) - window + 1):
            w = tuple(ws[i : i + window])
            first[w] = min(first.get(w, LAST + 1), o)
    found = []
    for (doc_id, _), ws, o in zip(documents, words, order):
        gone = set()
        for i in range(len(ws) - window + 1):
            if first[tuple(ws[i : i + window])] < o:
                gone.update(range(i, i + window))
        kept = b" ".join(w for i, w in enumerate(ws) if i not in gone)
        found.append((doc_id, len(ws), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=repr)


def rows(df):
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()]
    return sorted(got, key=repr)


def passages(rng, n):
    shared = [" ".join(rng.choice("abcde") for _ in range(rng.randint(5, 30))) for _ in range(6)]
    found = []
    for i in range(n):
        parts = [" ".join(rng.choice("vwxyz") for _ in range(rng.randint(0, 15)))]
        for _ in range(rng.randint(0, 3)):
            parts.append(rng.choice(shared))
            parts.append(" ".join(rng.choice("vwxyz") for _ in range(rng.randint(0, 15))))
        found.append((rng.choice([i, i, i, 3, None]), " ".join(parts)))
    return found


@pytest.mark.parametrize("hot", [0, 10_000])
def test_random_passages(spark, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT_SEGMENTS", hot)
    monkeypatch.setattr(substring_dedup, "SHARD_WORDS", 200)
    documents = passages(random.Random(hot), 80)
    found = repeated_passages(table(spark, documents), window=6, run=3)
    assert rows(found) == brute(documents, 6)


def test_edge_rows(spark):
    assert rows(repeated_passages(table(spark, EDGE))) == brute(EDGE, 50)


def test_empty_table(spark):
    assert repeated_passages(empty(spark)).collect() == []


def test_equal_windows_have_equal_keys():
    rng = np.random.default_rng(1)
    part = rng.integers(0, 1 << 62, 60).astype(np.uint64)
    texts = [
        np.concatenate([rng.integers(0, 1 << 62, n).astype(np.uint64), part]) for n in (3, 40, 7)
    ]
    sizes = np.array([len(t) for t in texts])
    found = segments(np.concatenate(texts), sizes, 50, 12)
    keys = []
    for i, n in enumerate((3, 40, 7)):
        own = {}
        for text, start, windows, key in zip(*(found[c] for c in ("text", "start", "windows", "key"))):
            if text == i:
                own.update(dict.fromkeys(range(start, start + windows), key))
        assert sorted(own) == list(range(sizes[i] - 49))
        keys.append([own[n + k] for k in range(11)])
    assert keys[0] == keys[1] == keys[2]


def test_backward_search_counts_occurrences():
    rng = np.random.default_rng(2)
    tokens = np.append(rng.integers(0, 5, 399), 0)
    index = FMIndex(tokens, np.arange(400), 8)
    text = tokens.tolist()
    for _ in range(200):
        start = int(rng.integers(0, 390))
        pattern = text[start : start + int(rng.integers(1, 8))]
        if 0 in pattern:
            continue
        low, high = np.array([0]), np.array([400])
        for symbol in reversed(pattern):
            low, high = index.extend(np.array([symbol]), low, high)
        count = sum(text[i : i + len(pattern)] == pattern for i in range(400))
        assert int(high[0] - low[0]) == count


def test_matching_statistics_of_texts_not_in_the_index():
    rng = np.random.default_rng(3)
    for symbols in (3, 6, 30):
        held = np.append(rng.integers(1, symbols, 400), 0)
        held[rng.integers(0, 400, 20)] = 0
        sizes = rng.integers(0, 60, 25)
        texts = [rng.integers(1, symbols + 1, n) for n in sizes]
        for text in texts[:12]:
            at = rng.integers(0, 340)
            text[len(text) // 3 :] = held[at : at + len(text) - len(text) // 3]
            text[text == 0] = symbols
        streamed = np.concatenate([np.append(t, 0) for t in texts])
        owners = rng.integers(0, 50, len(held))
        index = FMIndex(held, owners, 8, symbols + 1)
        begins = np.cumsum(sizes + 1) - sizes - 1
        lengths, least = index.matches(streamed, begins, sizes)
        parts = {}
        for i in range(len(held)):
            for k in range(1, 9):
                parts.setdefault(tuple(held[i : i + k]), []).append(owners[i])
        for begin, text in zip(begins.tolist(), map(tuple, texts)):
            for i in range(len(text)):
                known = [k for k in range(1, 9) if i + k <= len(text) and text[i : i + k] in parts]
                assert lengths[begin + i] == max(known, default=0)
                whole = text[i : i + 8]
                assert least[begin + i] == (min(parts[whole]) if 8 in known else -1)


def test_the_answer_rests_on_the_backward_search(monkeypatch):
    rng = random.Random(8)
    words = [[rng.choice([b"a", b"b"]) for _ in range(20)] for _ in range(12)]
    right = shard_ranges(words, list(range(12)), 4)
    # Nothing is ever prolonged; a match that can't be prolonged is given up as a whole.
    for name, broken in (
        ("extend", lambda self, symbol, low, high: (high, high)),
        ("shrunk", lambda self, symbol, low, *_: (low * 0, low * 0 + self.size, low * 0)),
    ):
        with monkeypatch.context() as patch:
            patch.setattr(FMIndex, name, broken)
            assert shard_ranges(words, list(range(12)), 4) != right


def test_shards_of_several_keys():
    rng = random.Random(9)
    owners, keys = [rng.randint(0, 30) for _ in range(60)], [rng.randint(0, 9) for _ in range(60)]
    # Windows of one key only are ever equal; words of two keys may be.
    words = [[rng.choice([b"a", b"b", b"%d" % k]) for _ in range(12)] for k in keys]
    words = [[b"%d" % k if i % 4 == 3 else w for i, w in enumerate(t)] for k, t in zip(keys, words)]
    together = shard_ranges(words, owners, 4, keys)
    for k in set(keys):
        own = [i for i, x in enumerate(keys) if x == k]
        alone = shard_ranges([words[i] for i in own], [owners[i] for i in own], 4)
        assert alone == [together[i] for i in own]


def test_shard_finds_the_smallest_owner():
    rng = random.Random(7)
    words = [[rng.choice([b"a", b"b"]) for _ in range(rng.randint(4, 30))] for _ in range(40)]
    owners = [rng.randint(0, 20) for _ in words]
    for text, own, ranges in zip(words, owners, shard_ranges(words, owners, 4)):
        expected = set()
        for i in range(len(text) - 3):
            if any(
                o < own and text[i : i + 4] in [w[j : j + 4] for j in range(len(w) - 3)]
                for w, o in zip(words, owners)
            ):
                expected.add(i)
        assert {i for a, b in ranges for i in range(a, b)} == expected
