"""Quality of documents by attention-based multiple-instance learning.

A document is a bag of *passages* of ``PASSAGE_WORDS`` words; only documents are labelled.
Every passage is encoded, a gated attention network learns from the document labels how
much each passage counts, and the weighted sum of the encodings gives the score, which
rises with the likelihood of label 1.

A passage's features are the shares of pairs of neighbouring character classes (so they
hold for any language) and a few shares of its words: different ones, such that repeat
their neighbour, such that the text had before, alone and in runs of four.

Learning is on a bounded sample: the first ``MAX_TRAINING`` labelled documents in the
order of a hash of the id, of at most ``LONGEST`` passages each, and as many of these as
have ``MAX_PASSAGES`` passages together.  Their features come to the driver, where the
network is fitted (about 20,000 numbers, whatever the corpus).  Scoring reads every word
of every text; only its own passages bear on a text's score.

Rows: null and empty texts are one passage without a word and get its score; a very long
text is one row of a task, whose memory grows with the longest text; null ids or labels
teach nothing; a document with several labels is learned with each; if there are no labels
or only one of them, every score is their mean (0.5 without any); repeated rows get
repeated scores; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailspark.llm.common import small_batches, text_slices
from mailspark.sources.scratch import written

PASSAGE_WORDS = 64
MAX_TRAINING = 6_000
MAX_PASSAGES = 60_000
LONGEST = 2_000
THRESHOLD = 0.3

#: Encoding and attention: units; fitting: passes, documents per step, step size, decay.
ENCODED, ATTENDED = 32, 16
PASSES, BATCH, STEP, DECAY = 30, 32, 3e-3, 1e-4
SEED = 42
BYTES_AT_ONCE = 1 << 20

#: Character classes; bytes of none of them are the last class.
CLASSES = (
    b" \t", b"\n\r\x0b\x0c", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789", bytes(range(0x80, 0x100)), b".", b",;:", b"!?", b"#", b"$%", b"&*",
    b"|<>", b"-_/=@+~^\\", b"\"'`()[]{}",
)
_KINDS = len(CLASSES) + 1
_CLASS_OF = np.full(256, _KINDS - 1, np.uint8)
for _i, _members in enumerate(CLASSES):
    _CLASS_OF[list(_members)] = _i
_GAP = np.zeros(256, bool)
_GAP[list(b" \t\n\r\x0b\x0c")] = True
WORD_FEATURES = 7
FEATURES = _KINDS * _KINDS + WORD_FEATURES


@dataclass(frozen=True)
class Passages:
    """Features of all passages of some texts, and where each text's passages begin."""

    features: np.ndarray
    starts: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(np.append(self.starts, len(self.features)))


def _seen_before(keys: np.ndarray) -> np.ndarray:
    """Whether an equal key stands earlier."""
    _, first = np.unique(keys, return_index=True)
    seen = np.ones(len(keys), bool)
    seen[first] = False
    return seen


def passages(texts: list[str], size: int = PASSAGE_WORDS) -> Passages:
    """The passages of texts; a text without words is one passage."""
    parts = [t.encode("utf-8", "replace") + b"\n" for t in texts]
    data = np.frombuffer(b"".join(parts), np.uint8)
    lengths = np.array([len(p) for p in parts], np.int64)
    offsets = np.cumsum(lengths) - lengths
    gap = _GAP[data]
    word_starts = np.flatnonzero(~gap & np.concatenate([[True], gap[:-1]]))
    text_of = np.searchsorted(offsets, word_starts, "right") - 1
    in_text = np.arange(len(word_starts)) - np.searchsorted(word_starts, offsets)[text_of]
    cuts = word_starts[(in_text > 0) & (in_text % size == 0)]
    begins = np.sort(np.concatenate([offsets, cuts]))
    n = len(begins)
    pairs = np.zeros((n, _KINDS * _KINDS), np.float32)
    classes = _CLASS_OF[data].astype(np.int32)
    last_of_text = np.zeros(len(data), bool)
    last_of_text[offsets + lengths - 1] = True
    for at in range(0, len(data) - 1, BYTES_AT_ONCE):
        here = np.arange(at, min(at + BYTES_AT_ONCE, len(data) - 1))
        here = here[~last_of_text[here]]  # no pair reaches into the next text
        owner = np.searchsorted(begins, here, "right") - 1
        if len(owner):
            low, high = owner[0], owner[-1] + 1
            keys = (owner - low) * _KINDS**2 + classes[here] * _KINDS + classes[here + 1]
            found = np.bincount(keys, minlength=(high - low) * _KINDS**2)
            pairs[low:high] += found.reshape(-1, _KINDS**2)
    pairs = np.sqrt(pairs / np.maximum(pairs.sum(axis=1, keepdims=True), 1))

    tokens = b"".join(parts).split()
    words = np.fromiter(map(crc32, tokens), np.uint64, len(tokens))
    sizes = np.fromiter(map(len, tokens), np.float64, len(tokens))
    passage = np.searchsorted(begins, word_starts, "right") - 1
    mixed = words * np.uint64(0x9E3779B97F4A7C15)

    def of_text(hashes: np.ndarray) -> np.ndarray:
        return hashes ^ (text_of.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))

    def share(flags: np.ndarray) -> np.ndarray:
        return np.bincount(passage, flags, n) / np.maximum(total, 1)

    total = np.bincount(passage, minlength=n).astype(np.float64)
    again = np.zeros(len(words))
    again[1:] = (words[1:] == words[:-1]) & (text_of[1:] == text_of[:-1])
    fours = mixed.copy()
    for k in range(1, 4):
        later = np.zeros_like(mixed)
        later[: len(mixed) - k] = mixed[k:] if k < len(mixed) else 0
        fours = fours * np.uint64(0x100000001B3) ^ later
    inside = np.zeros(len(words), bool)
    inside[: max(0, len(words) - 3)] = text_of[3:] == text_of[:-3] if len(words) > 3 else False
    own = passage.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    by_words = [
        np.log1p(total) / np.log1p(size),
        share(_seen_before(mixed ^ own).astype(float)),
        share(again),
        share(_seen_before(of_text(mixed)).astype(float)),
        share((_seen_before(of_text(fours)) & inside).astype(float)),
        share(sizes) / 10,
        share((sizes <= 2).astype(float)),
    ]
    features = np.concatenate([pairs, np.stack(by_words, axis=1).astype(np.float32)], axis=1)
    return Passages(features, np.searchsorted(begins, offsets))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass(frozen=True)
class Network:
    """A gated attention network over passages, or a constant where nothing is learned."""

    weights: dict[str, np.ndarray]
    constant: float | None = None

    def forward(self, bags: Passages) -> dict[str, np.ndarray]:
        w = self.weights
        x = (bags.features - w["mean"]) / w["spread"]
        h = np.tanh(x @ w["encode"] + w["encode_bias"])
        t, g = np.tanh(h @ w["attend"]), _sigmoid(h @ w["gate"])
        raised = (t * g) @ w["attention"]
        counts = bags.counts()
        top = np.repeat(np.maximum.reduceat(raised, bags.starts), counts)
        e = np.exp(raised - top)
        a = e / np.repeat(np.add.reduceat(e, bags.starts), counts)
        z = np.add.reduceat(a[:, None] * h, bags.starts, axis=0)
        return dict(x=x, h=h, t=t, g=g, a=a, z=z, p=_sigmoid(z @ w["out"] + w["out_bias"]))

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.constant is not None or not texts:
            return np.full(len(texts), self.constant or 0.0)
        return self.forward(passages(texts))["p"].astype(np.float64)

    def gradients(self, bags: Passages, labels: np.ndarray) -> dict[str, np.ndarray]:
        w, f, counts = self.weights, self.forward(bags), bags.counts()
        up = (f["p"] - labels) / len(labels)
        dz = np.repeat(up[:, None] * w["out"], counts, axis=0)
        da = (f["h"] * dz).sum(axis=1)
        mean = np.repeat(np.add.reduceat(f["a"] * da, bags.starts), counts)
        ds = f["a"] * (da - mean)
        dt = ds[:, None] * w["attention"] * f["g"] * (1 - f["t"] ** 2)
        dg = ds[:, None] * w["attention"] * f["t"] * f["g"] * (1 - f["g"])
        dh = f["a"][:, None] * dz + dt @ w["attend"].T + dg @ w["gate"].T
        de = dh * (1 - f["h"] ** 2)
        return {
            "out": f["z"].T @ up,
            "out_bias": up.sum(),
            "attention": (f["t"] * f["g"]).T @ ds,
            "attend": f["h"].T @ dt,
            "gate": f["h"].T @ dg,
            "encode": f["x"].T @ de,
            "encode_bias": de.sum(axis=0),
        }


def initial(features: np.ndarray, share: float) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(SEED)

    def scaled(rows: int, *columns: int) -> np.ndarray:
        return (rng.normal(0, rows**-0.5, (rows, *columns))).astype(np.float32)

    return {
        "mean": features.mean(axis=0),
        "spread": features.std(axis=0) + np.float32(1e-2),
        "encode": scaled(features.shape[1], ENCODED),
        "encode_bias": np.zeros(ENCODED, np.float32),
        "attend": scaled(ENCODED, ATTENDED),
        "gate": scaled(ENCODED, ATTENDED),
        "attention": scaled(ATTENDED),
        "out": scaled(ENCODED),
        "out_bias": np.float32(np.log(share / (1 - share))),
    }


def _bags(passage_sets: list[np.ndarray]) -> Passages:
    sizes = np.array([len(p) for p in passage_sets])
    return Passages(np.concatenate(passage_sets), np.cumsum(sizes) - sizes)


def fit(bags: list[np.ndarray], labels: np.ndarray) -> Network:
    """Adam over small batches of documents, always in the same order."""
    share = float(labels.mean()) if len(labels) else 0.5
    if share in (0.0, 1.0) or not len(labels):
        return Network({}, share)
    net = Network(initial(np.concatenate(bags), share))
    rng = np.random.default_rng(SEED)
    first: dict[str, np.ndarray] = {}
    second: dict[str, np.ndarray] = {}
    step = 0
    for epoch in range(PASSES):
        order = rng.permutation(len(bags))
        rate = STEP * (1 - epoch / PASSES)
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            step += 1
            for name, g in net.gradients(_bags([bags[i] for i in some]), labels[some]).items():
                first[name] = 0.9 * first.get(name, 0) + 0.1 * g
                second[name] = 0.999 * second.get(name, 0) + 0.001 * g * g
                move = first[name] / (1 - 0.9**step)
                move = move / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
                old = net.weights[name]
                net.weights[name] = (old - rate * (move + DECAY * old)).astype(np.float32)
    return net


def encoded(docs: DataFrame) -> DataFrame:
    """key, label, n, features of the passages, from rows with key, label and text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches, "text"):
            found = passages(texts)
            ends = np.append(found.starts[1:], len(found.features))
            blobs = [found.features[a:b].tobytes() for a, b in zip(found.starts, ends)]
            yield pa.RecordBatch.from_arrays(
                [rows.column("key"), rows.column("label"), pa.array(found.counts()), pa.array(blobs, pa.binary())],
                ["key", "label", "n", "features"],
            )

    return small_batches(docs).mapInArrow(run, "key long, label double, n long, features binary")


def learn(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAINING) -> Network:
    """Fit on documents (doc_id, text) with labels (doc_id, label), at most ``most`` of them."""
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
        .withColumn("key", F.xxhash64("doc_id"))
        .orderBy("key", "label")
        .limit(most)
    )
    rows = docs.join(F.broadcast(chosen), "doc_id").select(  # at most ``most`` rows
        "key", F.col("label").cast("double").alias("label"), F.col("text").cast("string").alias("text")
    )
    sample = written(encoded(rows), "quality-sample")
    sizes = sample.where(F.col("n") <= LONGEST).groupBy("key").agg(F.sum("n").alias("n"))
    sizes = sizes.orderBy("key").collect()  # at most ``most`` rows
    fitting = [r["key"] for r, n in zip(sizes, np.cumsum([r["n"] for r in sizes])) if n <= MAX_PASSAGES]
    if not fitting:
        return fit([], np.zeros(0))
    kept = sample.where((F.col("key") <= fitting[-1]) & (F.col("n") <= LONGEST))
    found = sorted(
        ((r["key"], r["label"], bytes(r["features"])) for r in kept.toLocalIterator())
    )
    bags = [np.frombuffer(f, np.float32).reshape(-1, FEATURES) for _, _, f in found]
    return fit(bags, np.array([label for _, label, _ in found], np.float32))


def quality_column(net: Network):
    """A function from a text column to its score."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = pa.RecordBatch.from_arrays([batch], ["text"])
            parts = [net.scores(texts) for _, texts in text_slices([rows], "text")]
            yield pa.array(np.concatenate([np.zeros(0), *parts]), pa.float64())

    return score


def held_out(doc_id: Column) -> Column:
    """Documents whose labels teach nothing."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def quality_model(docs: DataFrame, labels: DataFrame, label_column: str = "quality") -> Network:
    """What the labels (doc_id, quality) of documents that aren't held out teach."""
    teaching = labels.where(~held_out(F.col("doc_id"))).select(
        "doc_id", F.col(label_column).cast("double").alias("label")
    )
    return learn(docs.select("doc_id", "text"), teaching)


def score_documents(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id, score of all documents."""
    text = F.col("text").cast("string")
    return small_batches(docs).select("doc_id", quality_column(net)(text).alias("score"))
