"""SentencePiece encoding and decoding by suffix-array matching.

A vocabulary of byte-pair pieces is read from its model file; encoding is our own.  The
words of a slice that a worker hasn't met yet are concatenated and indexed by a suffix
array.  Every piece is binary-searched for the range of suffixes that begin with it, so
all places where pieces occur come as edges (start, end, piece).  Sorted by position
they are relaxed from left to right: the encoding of a beginning of a word ends in the
one piece that agrees with the encoding before it, where two pieces agree if the merges
of their joint letters leave both whole.  So the best path is the one the merges make,
and ids equal those of the reference implementation.

Merges never cross the border of a letter and a following space mark, if no piece does;
then words are encoded one by one, else whole texts.  Words with several space marks in a
row are merged directly: pieces of marks alone have equal scores, and only the order of
merges decides between them.

Letters without a piece become bytes, or the unknown id where the vocabulary has no bytes.

Rows: a null or empty text has no ids and decodes to the empty text; null ids stay null;
repeated rows are encoded each; an empty table gives no rows; other columns are not read.
A space mark in a text decodes to a space, as with the reference implementation.
"""

from __future__ import annotations

import array
import heapq
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailspark.llm.common import small_batches, text_slices
from mailspark.llm.repetition import suffix_order

MARK = "▁"
#: Words, and pairs of pieces, that a worker remembers; only speed depends on it.
REMEMBERED = 600_000
#: Stands between words in the index; no code point.
BORDER = 0x110000
#: Bytes of text whose new words are indexed together.
SLICE = 2 << 20
ID_BYTES = 4
_RUNS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def suffix_ranges(text: np.ndarray, order: np.ndarray, wanted: list[np.ndarray]):
    """For each wanted string the range of sorted suffixes that begin with it."""
    n = len(text)
    first = np.zeros(len(wanted), np.int64)
    last = np.full(len(wanted), n, np.int64)
    sizes = np.fromiter(map(len, wanted), np.int64, len(wanted))
    padded = np.append(text, np.full(int(sizes.max(initial=0)) + 1, -1))
    letters = np.full((len(wanted), int(sizes.max(initial=0))), -1, np.int64)
    for i, w in enumerate(wanted):
        letters[i, : len(w)] = w

    def bound(which: np.ndarray, depth: int, beyond: bool) -> np.ndarray:
        low, high, letter = first[which].copy(), last[which].copy(), letters[which, depth]
        while (open_ := low < high).any():
            middle = (low + high) // 2
            found = padded[order[np.minimum(middle, n - 1)] + depth]
            right = open_ & ((found <= letter) if beyond else (found < letter))
            low = np.where(right, middle + 1, low)
            high = np.where(open_ & ~right, middle, high)
        return low

    for depth in range(letters.shape[1]):
        which = np.flatnonzero((sizes > depth) & (first < last))
        if not len(which):
            break
        low, high = bound(which, depth, False), bound(which, depth, True)
        first[which], last[which] = low, high
    return first, last


class Pieces:
    """A vocabulary and what a worker has learned of it."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(size)]
        self.texts = [model.id_to_piece(i) for i in range(size)]
        self.scores = [model.get_score(i) for i in range(size)]
        self.ids = {t: i for i, t in enumerate(self.texts) if not special[i]}
        self.bytes = {
            int(self.texts[i][3:5], 16): i for i in range(size) if model.is_byte(i)
        }
        byte_of = {i: b for b, i in self.bytes.items()}
        spelled = [
            bytes([byte_of[i]]) if i in byte_of else t.replace(MARK, " ").encode()
            for i, t in enumerate(self.texts)
        ]
        self.data = np.frombuffer(b"".join(spelled), np.uint8)
        self.sizes = np.fromiter(map(len, spelled), np.int64, size)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.unknown = model.unk_id()
        self.by_words = not any(MARK in t.lstrip(MARK) for t in self.ids)
        self.wanted = list(self.ids.values())
        self.wanted_text = [
            np.fromiter(map(ord, self.texts[i]), np.int64, len(self.texts[i])) for i in self.wanted
        ]
        self.known: dict[str, bytes] = {}
        self.agreeing: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}

    def merged(self, text: str) -> list[int]:
        """Ids after merging the best pairs, the leftmost of equals first; -1 - letter
        for a letter without a piece."""
        ids, scores = self.ids, self.scores
        symbols: list = list(text)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda: list = []

        def offer(i: int) -> None:
            j = after[i]
            if i >= 0 and j < n:
                both = symbols[i] + symbols[j]
                if (piece := ids.get(both)) is not None:
                    heapq.heappush(agenda, (-scores[piece], i, both, j))

        for i in range(n - 1):
            offer(i)
        while agenda:
            _, i, both, j = heapq.heappop(agenda)
            if symbols[i] is None or after[i] != j or symbols[j] is None:
                continue
            if symbols[i] + symbols[j] != both:
                continue
            symbols[i], symbols[j] = both, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [ids.get(s, -1 - ord(s[0])) for s in symbols if s is not None]

    def is_whole(self, piece: int) -> bool:
        if (known := self.whole.get(piece)) is None:
            known = self.whole[piece] = self.merged(self.texts[piece]) == [piece]
        return known

    def agree(self, a: int, b: int) -> bool:
        return self.merged(self.texts[a] + self.texts[b]) == [a, b]

    def fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Of each pair of pieces, whether they agree; different pairs are tried once."""
        keys, place = np.unique(left * len(self.texts) + right, return_inverse=True)
        known, found = self.agreeing, np.empty(len(keys), bool)
        for i, key in enumerate(keys.tolist()):
            fits = known.get(key)
            if fits is None:
                fits = known[key] = self.agree(*divmod(key, len(self.texts)))
            found[i] = fits
        return found[place]

    def edges(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, length and piece of all places of pieces; -1 - letter where it has none."""
        order, _ = suffix_order(text)
        first, last = suffix_ranges(text, order, self.wanted_text)
        found = np.flatnonzero(first < last)
        found = found[[self.is_whole(self.wanted[i]) for i in found.tolist()]]
        counts = last[found] - first[found]
        at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = order[np.repeat(first[found], counts) + at]
        piece = np.repeat(np.array(self.wanted, np.int64)[found], counts)
        sizes = np.fromiter((len(self.wanted_text[i]) for i in found), np.int64, len(found))
        length = np.repeat(sizes, counts)
        bare = text < BORDER
        bare[starts[length == 1]] = False
        bare = np.flatnonzero(bare)
        return (
            np.append(starts, bare),
            np.append(length, np.ones(len(bare), np.int64)),
            np.append(piece, -1 - text[bare]),
        )

    def relaxed(self, words: list[str]) -> list[bytes]:
        """Ids of words, by edges from a suffix array over all of them.

        All words take their steps together, each step one letter further.
        """
        joined = chr(0).join(words) + chr(0)
        text = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        begins = ends - sizes
        text[ends] = BORDER
        starts, length, piece = self.edges(text)
        word = np.repeat(np.arange(len(words)), sizes + 1)
        offset = starts - begins[word[starts]]
        narrow = np.uint16 if sizes.max(initial=0) < 1 << 16 else np.int64
        by = np.argsort(offset.astype(narrow), kind="stable")
        starts, length, piece, offset = starts[by], length[by], piece[by], offset[by]
        steps = np.searchsorted(offset, np.arange(int(sizes.max(initial=0)) + 1))
        # The last piece of the encoding up to a place, and where that piece begins.
        none = np.iinfo(np.int64).min
        last_piece = np.full(len(text) + 1, none)
        came = np.zeros(len(text) + 1, np.int64)
        for low, high in zip(steps[:-1], steps[1:]):
            i, n, p = starts[low:high], length[low:high], piece[low:high]
            q = last_piece[i]
            good = q != none if offset[low : low + 1].any() else np.ones(len(i), bool)
            both = np.flatnonzero(good & (q >= 0) & (p >= 0))
            good[both] = self.fits(q[both], p[both])
            i, n, p = i[good], n[good], p[good]
            last_piece[i + n] = p
            came[i + n] = i
        # Back from the ends: pieces at the places where they begin.
        at_start = np.full(len(text), none)
        place = ends
        while len(place):
            before = came[place]
            at_start[before] = last_piece[place]
            place = before[before > begins[word[before]]]
        chosen = np.flatnonzero(at_start != none)
        ids = at_start[chosen]
        bounds = np.searchsorted(chosen, np.append(begins, len(text)))
        data = np.maximum(ids, 0).astype("<u4").tobytes()
        cuts = (bounds * ID_BYTES).tolist()
        found = [data[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        for word in np.unique(np.searchsorted(bounds, np.flatnonzero(ids < 0), side="right") - 1):
            found[word] = self.as_bytes(ids[bounds[word] : bounds[word + 1]].tolist())
        return found

    def as_bytes(self, ids: list[int]) -> bytes:
        found: list[int] = []
        for i in ids:
            if i >= 0:
                found.append(i)
            elif self.bytes:
                found.extend(self.bytes[b] for b in chr(-1 - i).encode())
            else:
                found.append(self.unknown)
        return array.array("I", found).tobytes()

    def words_of(self, text: str) -> list[str]:
        """Words without their first space mark."""
        if not text:
            return []
        text = text.replace(MARK, " ")
        if not self.by_words:
            return [text]
        if "  " not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        marked = MARK + text.replace(" ", MARK)
        return [w[1:] for w in _RUNS.findall(marked)]

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self.words_of(t) for t in texts]
        met: set[str] = set()
        for words in split:
            met.update(words)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        if len(self.agreeing) > REMEMBERED:
            self.agreeing.clear()
        new = sorted(w for w in met if w not in self.known)
        marked = [MARK + w.replace(" ", MARK) for w in new]
        direct = [MARK + MARK in m or chr(0) in m for m in marked]
        for word, m, d in zip(new, marked, direct):
            if d:
                self.known[word] = self.as_bytes(self.merged(m))
        indexed = [i for i, d in enumerate(direct) if not d]
        if indexed:
            for i, ids in zip(indexed, self.relaxed([marked[i] for i in indexed])):
                self.known[new[i]] = ids
        get = self.known.__getitem__
        return [b"".join(map(get, words)) for words in split]

    def decode(self, ids: bytes) -> str:
        found = np.frombuffer(ids, "<u4")
        sizes = self.sizes[found]
        first = self.starts[found] - (np.cumsum(sizes) - sizes)
        text = self.data[np.repeat(first, sizes) + np.arange(sizes.sum())]
        text = text.tobytes().decode(errors="replace")
        return text[1:] if text.startswith(" ") else text


_PIECES: dict[str, Pieces] = {}


def worker_pieces(path: str) -> Pieces:
    if path not in _PIECES:
        _PIECES[path] = Pieces(path)
    return _PIECES[path]


def _coded(docs: DataFrame, model: str, id_column: str, text_column: str, back: bool) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = worker_pieces(model)
        for rows, texts in text_slices(batches, "text", SLICE):
            ids = pieces.encode(texts)
            columns = [rows.column("doc_id"), rows.column("text"), pa.array(ids, pa.binary())]
            names = ["doc_id", "text", "ids"]
            if back:
                columns.append(pa.array(map(pieces.decode, ids), pa.string()))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays(columns, names)

    return small_batches(docs).select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).cast("string").alias("text"),
    ).mapInArrow(
        run, "doc_id long, text string, ids binary" + ", decoded string" * back
    )


def encode(
    docs: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, text and ids (unsigned little-endian 32-bit numbers) of every text."""
    return _coded(docs, model, id_column, text_column, back=False)


def encode_and_decode(
    docs: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """As ``encode``, and decoded, the text of the ids, by the same worker."""
    return _coded(docs, model, id_column, text_column, back=True)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """Adds decoded, the text of the ids; null ids decode to the empty text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = worker_pieces(model)
        for batch in batches:
            texts = [pieces.decode(x or b"") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())],
                [*batch.schema.names, "decoded"],
            )

    schema = ", ".join(f"`{n}` {t}" for n, t in encoded.dtypes)
    return encoded.mapInArrow(run, f"{schema}, decoded string")
