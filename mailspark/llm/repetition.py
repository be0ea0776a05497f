"""Quality rules on repetition, from the suffix array of each text's words.

The texts of a slice are indexed together.  Words are numbered per text, so suffixes
of different texts never agree.  Prefix doubling sorts the suffixes; only those that
still agree with a neighbour are sorted again.  The ranks of all rounds give the longest
common prefix of neighbours in the sorted order, and with it the longest repeat that
begins at each word.  A repeat that the word before it doesn't prolong is maximal; the
union of the spans of maximal repeats of at least ``MIN_WORDS`` words is the covered
part of a text.

A text is kept if it passes the base rules and neither the covered fraction nor the
longest repeat is beyond its limit.

Memory: some 200 bytes for each word of a slice, or of a longer text.

Rows: a null text has no words and fails the base rules, as an empty one does; null ids
stay null; repeated rows get repeated results; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailspark.llm.common import small_batches, text_slices

#: Words of the shortest repeat that counts.
MIN_WORDS = 8
#: Base rules.
LEAST_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Limits of the method: percent of words covered, and words of the longest repeat.
MAX_COVERED_PERCENT = 30
MAX_LONGEST = 50
SYMBOLS = "#*$%&|<>"
BLANK = " \t\n\v\f\r"


def suffix_order(
    tokens: np.ndarray, depth: int | None = None
) -> tuple[np.ndarray, list[np.ndarray]]:
    """The sorted suffixes, and for each round their ranks by the first 2**round tokens.

    A rank is the place of the first suffix with the same beginning.  Ranks have one
    more entry, for the empty suffix.  With ``depth`` suffixes are sorted by as many
    tokens at least; equal ones stay in order of their places.
    """
    n = len(tokens)
    order = np.argsort(tokens, kind="stable")
    new = np.empty(n, bool)
    new[:1] = True
    new[1:] = tokens[order[1:]] != tokens[order[:-1]]
    rank = np.full(n + 1, -1, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rounds, h = [rank.copy()], 1
    last = np.append(new[1:], True)
    open_ = np.flatnonzero(~(new & last))
    while len(open_) and (depth is None or h < depth):
        suffixes = order[open_]
        key = rank[suffixes] * (n + 1) + rank[np.minimum(suffixes + h, n)] + 1
        by = np.argsort(key, kind="stable")
        suffixes, key = suffixes[by], key[by]
        order[open_] = suffixes
        new = np.append(True, key[1:] != key[:-1])
        rank[suffixes] = np.maximum.accumulate(np.where(new, open_, 0))
        rounds.append(rank.copy())
        last = np.append(new[1:], True)
        open_ = open_[~(new & last)]
        h *= 2
    return order, rounds


def longest_repeats(tokens: np.ndarray, least: int) -> np.ndarray:
    """Of each place, the length of the longest repeat that begins there; 0 below ``least``."""
    longest = np.zeros(len(tokens) + 1, np.int64)
    if not len(tokens):
        return longest
    order, rounds = suffix_order(tokens)
    a, b = order[:-1], order[1:]
    known = min(least.bit_length() - 1, len(rounds) - 1)
    agree = rounds[known][a] == rounds[known][b]
    a, b = a[agree], b[agree]
    common = np.zeros(len(a), np.int64)
    for k in reversed(range(len(rounds))):
        same = rounds[k][a + common] == rounds[k][b + common]
        common[same] += 1 << k
    enough = common >= least
    for side in (a, b):
        np.maximum.at(longest, side[enough], common[enough])
    return longest


def maximal_repeats(longest: np.ndarray) -> np.ndarray:
    """Places where a repeat begins that isn't part of one beginning a word before."""
    before = np.append(0, longest[:-1])
    return np.flatnonzero((longest > 0) & (before != longest + 1))


def repeated_spans(words: list[list], least: int = MIN_WORDS) -> list[tuple]:
    """Per text: repeats as (start, stop) of their union, words covered, longest, number."""
    number: dict = defaultdict()
    number.default_factory = number.__len__
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    total = int(sizes.sum())
    ids = np.fromiter((number[w] for text in words for w in text), np.int64, total)
    text = np.repeat(np.arange(len(words)), sizes)
    longest = longest_repeats(text * max(1, len(number)) + ids, least)
    starts = maximal_repeats(longest)
    change = np.zeros(total + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + longest[starts], -1)
    covered = np.cumsum(change) > 0
    # A span ends where coverage or the text does.
    inside = covered[:total]
    edge = np.append(0, text[1:] != text[:-1]).astype(bool) if total else np.zeros(0, bool)
    opens = np.flatnonzero(inside & (np.append(False, ~inside[:-1]) | edge)) if total else []
    if total and inside[0]:
        opens = np.unique(np.append(0, opens))
    closes = np.flatnonzero(inside & np.append(~inside[1:] | edge[1:], True)) + 1 if total else []
    found = []
    base = 0
    first = 0
    for n in sizes.tolist():
        stop = first
        while stop < len(opens) and opens[stop] < base + n:
            stop += 1
        own = [(int(a) - base, int(b) - base) for a, b in zip(opens[first:stop], closes[first:stop])]
        mine = longest[base : base + n]
        begun = int(np.searchsorted(starts, base + n) - np.searchsorted(starts, base))
        found.append((own, sum(b - a for a, b in own), int(mine.max(initial=0)), begun))
        base, first = base + n, stop
    return found


SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, longest_repeat long, n_repeats long, "
    "spans array<struct<start: long, stop: long>>"
)


def measure(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: int = MIN_WORDS
) -> DataFrame:
    """Counts and repeated spans (in words) of every text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for rows, texts in text_slices(batches, "text"):
            words = [t.encode().split() for t in texts]
            repeats = repeated_spans(words, least)
            lines = [[x for x in t.split("\n") if x.strip(BLANK)] for t in texts]
            schema = schema or pa.schema(
                [("doc_id", pa.int64())]
                + [(c, pa.int64()) for c in COUNTS]
                + [("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    pa.array([len(w) for w in words], pa.int64()),
                    pa.array([len(t) - sum(map(t.count, BLANK)) for t in texts], pa.int64()),
                    pa.array([sum(map(t.count, SYMBOLS)) for t in texts], pa.int64()),
                    pa.array([len(x) - len(set(x)) for x in lines], pa.int64()),
                    pa.array([r[1] for r in repeats], pa.int64()),
                    pa.array([r[2] for r in repeats], pa.int64()),
                    pa.array([r[3] for r in repeats], pa.int64()),
                    pa.array(
                        [[{"start": a, "stop": b} for a, b in r[0]] for r in repeats],
                        schema.field("spans").type,
                    ),
                ],
                schema=schema,
            )

    return small_batches(docs).select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).cast("string").alias("text"),
    ).mapInArrow(run, SCHEMA)


COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "longest_repeat",
    "n_repeats",
)


def judge(measured: DataFrame) -> DataFrame:
    """Adds base_failed and kept."""
    words, covered = F.col("n_words"), F.col("n_repeat_words")
    failed = (words < LEAST_WORDS) | (100 * covered > MAX_REPEAT_PERCENT * words)
    return measured.withColumn("base_failed", failed).withColumn(
        "kept",
        ~failed
        & (100 * covered <= MAX_COVERED_PERCENT * words)
        & (F.col("longest_repeat") <= MAX_LONGEST),
    )
