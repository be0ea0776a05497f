"""Language of texts and of the spans within them.

Every word gets a score for each language: the log probability of its letter n-grams,
learned from labelled texts.  The script of a word narrows the candidates to languages
that were seen in that script.  Viterbi with a penalty for switching then labels the
words of a text with the best sequence of languages, so single odd words don't break a
span but longer passages in another language do.  A text's language is the one with
most letters; its score is their share.

Learning.  The n-grams of a bounded sample of labelled texts (``MAX_TRAINING`` texts of
each language, chosen by a hash of the id) are counted into ``BUCKETS`` hashed
buckets.  The counts are aggregated by Spark; the model is ``BUCKETS`` numbers for each
language, whatever the corpus, and travels with the tasks.  Prediction reads every
word of every text; the texts of a slice take their Viterbi steps together.

Rows: a text that is null or has no letter is ``und`` with score 0, as is every text if
nothing is labelled; a text with null id or null label teaches nothing; repeated rows
get repeated results; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailspark.llm.common import small_batches, text_slices

UNKNOWN = "und"
MAX_TRAINING = 5000
BUCKETS = 1 << 16
SIZES = (1, 2, 3)
#: What changing the language between two words costs, in nats.
SWITCH = 15.0
#: What a language outside a word's script costs.
OUTSIDE = 1e4
#: A language is a candidate in a script that holds this share of its letters.
SCRIPT_SHARE = 1e-3
SLICE = 1 << 20

# First and last code points of scripts, from the Unicode blocks.
SCRIPTS = {
    "latin": ((0x41, 0x24F), (0x1E00, 0x1EFF), (0xFF21, 0xFF5A)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)),
    "armenian": ((0x530, 0x58F),),
    "hebrew": ((0x590, 0x5FF),),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)),
    "devanagari": ((0x900, 0x97F),),
    "bengali": ((0x980, 0x9FF),),
    "gurmukhi": ((0xA00, 0xA7F),),
    "gujarati": ((0xA80, 0xAFF),),
    "tamil": ((0xB80, 0xBFF),),
    "telugu": ((0xC00, 0xC7F),),
    "kannada": ((0xC80, 0xCFF),),
    "malayalam": ((0xD00, 0xD7F),),
    "thai": ((0xE00, 0xE7F),),
    "georgian": ((0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)),
    "hangul": ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)),
    "ethiopic": ((0x1200, 0x139F),),
    "khmer": ((0x1780, 0x17FF),),
    "kana": ((0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)),
    "han": ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3134F)),
}
OTHER = len(SCRIPTS)

_LETTERS: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """Of each code point: 0 if it is no letter, else its script's place plus one."""
    if not _LETTERS:
        letters = np.fromiter(
            (chr(c).isalpha() for c in range(0x110000)), np.uint8, 0x110000
        )
        script = np.full(0x110000, OTHER + 1, np.uint8)
        for i, ranges in enumerate(SCRIPTS.values()):
            for first, last in ranges:
                script[first : last + 1] = i + 1
        _LETTERS.append(letters * script)
    return _LETTERS[0]


@dataclass
class Words:
    """Different words of some texts, and the texts as places in them."""

    points: np.ndarray
    starts: np.ndarray
    letters: np.ndarray
    scripts: np.ndarray
    ids: list[np.ndarray]


def split_words(texts: list[str]) -> Words:
    """Words between white space, lower-cased; what isn't a letter is a break."""
    number: dict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    ids = []
    for text in texts:
        words = text.encode().split()
        ids.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
    table = letter_table()
    joined = b" ".join(number).decode().lower()
    points = np.frombuffer(f" {joined} ".encode("utf-32-le"), np.uint32).astype(np.int64)
    blank = points == 32
    script = table[points]
    ends = np.flatnonzero(blank)
    starts = ends[:-1] if number else ends[:0]
    is_letter = script > 0
    total = np.append(0, np.cumsum(is_letter))
    letters = total[ends[1:]] - total[starts] if number else np.zeros(0, np.int64)
    # The place of the first letter at or after each place.
    place = np.where(is_letter, np.arange(len(points)), len(points) - 1)
    place = np.minimum.accumulate(place[::-1])[::-1]
    scripts = np.where(letters > 0, script[place[starts]], 0) if number else letters
    points = np.where(is_letter, points, 0)
    return Words(points, starts, letters, scripts.astype(np.int64), ids)


def ngrams(points: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size: buckets of the n-grams at all places, and which hold a letter.

    A break may begin or end an n-gram, not lie within it.
    """
    n = len(points)
    for size in SIZES:
        code = np.zeros(n, np.uint64)
        inner = np.ones(n, bool)
        some = np.zeros(n, bool)
        for k in range(size):
            letter = np.append(points[k:], np.zeros(k, np.int64))
            code = (code + letter.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            code ^= code >> np.uint64(29)
            some |= letter > 0
            if 0 < k < size - 1:
                inner &= letter > 0
        bucket = ((code * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(48)).astype(np.int64)
        if size == 1:
            inner &= points > 0
        yield bucket % BUCKETS, inner & some


def learn(docs: DataFrame, most: int = MAX_TRAINING) -> Model:
    """A model from docs (doc_id, text, lang)."""
    labelled = small_batches(docs).where("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    spread = float(1 << 32)
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32))
    chosen = F.lit(False)
    for lang, n in sizes.items():
        chosen = chosen | ((F.col("lang") == lang) & (draw < spread * min(1.0, most / n)))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches, "text", SLICE):
            langs = np.array(rows.column("lang").to_pylist())
            for lang in np.unique(langs):
                words = split_words([texts[i] for i in np.flatnonzero(langs == lang)])
                times = np.zeros(len(words.starts), np.int64)
                for ids in words.ids:
                    np.add.at(times, ids, 1)
                counts = np.zeros(BUCKETS + OTHER + 2, np.int64)
                if len(times):
                    weight = np.repeat(times, np.diff(np.append(words.starts, len(words.points) - 1)))
                    weight = np.append(weight, 0)
                    for bucket, valid in ngrams(words.points):
                        counts[:BUCKETS] += np.bincount(
                            bucket[valid], weight[valid], BUCKETS
                        ).astype(np.int64)
                    np.add.at(counts, BUCKETS + words.scripts, times * words.letters)
                used = np.flatnonzero(counts)
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": pa.array([lang] * len(used), pa.string()),
                        "bucket": pa.array(used, pa.int64()),
                        "n": pa.array(counts[used], pa.int64()),
                    }
                )

    counts = (
        labelled.where(chosen)
        .select("text", "lang")
        .mapInArrow(count, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    langs = sorted(counts["lang"].unique())
    table = np.zeros((BUCKETS + OTHER + 2, len(langs)))
    for i, lang in enumerate(langs):
        own = counts[counts["lang"] == lang]
        table[own["bucket"].to_numpy(), i] = own["n"].to_numpy()
    grams, scripts = table[:BUCKETS], table[BUCKETS:]
    scores = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * BUCKETS)).astype(np.float32)
    seen = scripts >= np.maximum(1, SCRIPT_SHARE * scripts.sum(axis=0))
    seen |= ~seen.any(axis=1, keepdims=True)
    seen[0] = True
    return Model(tuple(langs), scores, np.where(seen, 0, -OUTSIDE).astype(np.float32))


@dataclass
class Model:
    """Languages, log probabilities of buckets, and what each script costs a language."""

    langs: tuple[str, ...]
    scores: np.ndarray
    scripts: np.ndarray

    def word_scores(self, words: Words) -> np.ndarray:
        """Of every different word, a score for each language."""
        if not len(words.starts):
            return np.zeros((0, len(self.langs)), np.float32)
        total = np.zeros((len(words.points), len(self.langs)), np.float32)
        for bucket, valid in ngrams(words.points):
            total += self.scores[bucket] * valid[:, None]
        found = np.add.reduceat(total[:-1], words.starts, axis=0)
        return np.where(words.letters[:, None] > 0, found + self.scripts[words.scripts], 0)


def best_labels(scores: list[np.ndarray], switch: float = SWITCH) -> list[np.ndarray]:
    """Viterbi over the rows of each array; all arrays take their steps together."""
    by = sorted(range(len(scores)), key=lambda i: -len(scores[i]))
    sizes = np.array([len(scores[i]) for i in by], np.int64)
    longest = int(sizes.max(initial=0))
    n_langs = scores[0].shape[1] if scores else 0
    # Step by step: rows of all texts that are long enough, texts by falling length.
    active = np.searchsorted(-sizes, -np.arange(longest), side="left").astype(np.int64)
    begins = np.append(0, np.cumsum(active))
    flat = np.zeros((int(begins[-1]), n_langs), np.float32)
    places = [begins[: len(scores[i])] + k for k, i in enumerate(by)]
    for place, i in zip(places, by):
        flat[place] = scores[i]
    came = np.zeros(flat.shape, np.int8 if n_langs < 128 else np.int32)
    own = np.arange(n_langs, dtype=came.dtype)
    value = flat[: begins[1]].copy() if longest else flat
    ends = np.zeros(len(by), np.int64)
    for t in range(1, longest):
        n = active[t]
        if n < len(value):
            ends[n : len(value)] = value[n:].argmax(axis=1)
            value = value[:n]
        best = value.argmax(axis=1)
        top = value[np.arange(n), best] - switch
        stay = value >= top[:, None]
        came[begins[t] : begins[t + 1]] = np.where(stay, own, best[:, None])
        value = np.where(stay, value, top[:, None]) + flat[begins[t] : begins[t + 1]]
    if longest:
        ends[: len(value)] = value.argmax(axis=1)
    labels = np.zeros(int(begins[-1]), np.int64)
    state = np.zeros(0, np.int64)
    for t in reversed(range(longest)):
        state = np.append(state, ends[len(state) : active[t]])
        labels[begins[t] : begins[t + 1]] = state
        state = came[begins[t] + np.arange(active[t]), state].astype(np.int64)
    found: list = [None] * len(scores)
    for place, i in zip(places, by):
        found[i] = labels[place]
    return found


def verdicts(model: Model, texts: list[str]) -> list[tuple[str, float, list[dict]]]:
    """Of each text: its language, the score, and spans of words with their languages."""
    if not model.langs:
        return [(UNKNOWN, 0.0, []) for _ in texts]
    words = split_words(texts)
    table = model.word_scores(words)
    labels = best_labels([table[ids] for ids in words.ids])

    def verdict(labels: np.ndarray, letters: np.ndarray) -> tuple[str, float, list[dict]]:
        if not letters.sum():
            return UNKNOWN, 0.0, []
        share = np.bincount(labels, letters, len(model.langs))
        best = int(share.argmax())
        edges = np.flatnonzero(np.append(True, labels[1:] != labels[:-1]))
        spans = [
            {"start": int(a), "stop": int(b), "lang": model.langs[labels[a]]}
            for a, b in zip(edges, np.append(edges[1:], len(labels)))
        ]
        return model.langs[best], float(share[best] / share.sum()), spans

    return [verdict(x, words.letters[ids]) for x, ids in zip(labels, words.ids)]


SCHEMA = (
    "doc_id long, lang_pred string, score double, "
    "spans array<struct<start: long, stop: long, lang: string>>"
)


def predict(
    docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, lang_pred, score, and spans of words with their languages."""
    span = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("lang", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches, "text", SLICE):
            found = verdicts(model, texts)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                    pa.array([f[2] for f in found], pa.list_(span)),
                ],
                ["doc_id", "lang_pred", "score", "spans"],
            )

    return small_batches(docs).select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).cast("string").alias("text"),
    ).mapInArrow(run, SCHEMA)


def language_column(model: Model) -> Callable[[Column], Column]:
    """A function from a text column to a struct of lang_pred and score."""

    @F.arrow_udf("lang_pred string, score double")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = pa.RecordBatch.from_arrays([batch], ["text"])
            parts = []
            for _, texts in text_slices([rows], "text", SLICE):
                parts.extend(verdict[:2] for verdict in verdicts(model, texts))
            langs, scores = zip(*parts) if parts else ((), ())
            yield pa.StructArray.from_arrays(
                [pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                ["lang_pred", "score"],
            )

    return found


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def language_model(docs: DataFrame) -> Model:
    """What the documents (doc_id, text, lang) that aren't held out teach."""
    return learn(
        docs.where(~held_out(F.col("doc_id"))).select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("text").cast("string").alias("text"),
            F.col("lang").cast("string").alias("lang"),
        )
    )
