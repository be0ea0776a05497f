import random

from mailspark.llm.repetition import judge, measure, repeated_spans
from tests.llm.helpers import EDGE, empty, table


def brute(words, least):
    n = len(words)
    longest = [0] * n
    for i in range(n):
        for j in range(n):
            if i != j:
                k = 0
                while i + k < n and j + k < n and words[i + k] == words[j + k]:
                    k += 1
                longest[i] = max(longest[i], k)
    covered = set()
    for i, k in enumerate(longest):
        if k >= least:
            covered.update(range(i, i + k))
    return len(covered), max([k for k in longest if k >= least], default=0)


def test_repeats_against_all_pairs():
    rng = random.Random(1)
    texts = []
    for _ in range(60):
        size = rng.choice([0, 1, 3, 10, 40, 120])
        texts.append([rng.choice("ab" if rng.random() < 0.5 else "abcdefgh") for _ in range(size)])
    texts += [["x"] * 50, ["a", "b"] * 30]
    for least in (2, 3, 8):
        for words, (spans, covered, longest, n) in zip(texts, repeated_spans(texts, least)):
            assert (covered, longest) == brute(words, least)
            assert covered == sum(b - a for a, b in spans)
            assert all(a < b <= len(words) for a, b in spans)
            assert (n > 0) == (covered > 0)


def test_texts_of_a_slice_do_not_repeat_each_other():
    words = "one two three four five six seven eight nine ten".split()
    assert [r[1] for r in repeated_spans([words, words])] == [0, 0]


def test_edge_rows(spark):
    found = judge(measure(table(spark, EDGE))).collect()
    assert len(found) == len(EDGE)
    by_words = {r.n_words: r for r in found}
    assert by_words[0].base_failed and not by_words[0].kept
    long = by_words[90_000]
    assert (long.n_repeat_words, long.longest_repeat) == (90_000, 89_997)
    symbols = next(r for r in found if r.doc_id == 8)
    assert (symbols.n_symbols, symbols.n_words) == (8 + 8, 5)


def test_empty_table(spark):
    assert judge(measure(empty(spark))).collect() == []


def test_limits(spark):
    clean = " ".join(f"w{i}" for i in range(200))
    once = " ".join(f"v{i}" for i in range(51))
    long = f"{clean} {once} {' '.join(f'x{i}' for i in range(400))} {once}"
    lines = "a line\nb\n\na line\n \nb\nb"
    docs = table(spark, [(1, clean), (2, long), (3, lines), (4, f"{once} {once}")])
    found = {r.doc_id: r for r in judge(measure(docs)).collect()}
    assert found[1].kept
    assert not found[2].base_failed and not found[2].kept and found[2].longest_repeat == 51
    assert found[3].n_dup_lines == 3
    assert found[4].base_failed
