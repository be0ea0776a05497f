"""Documents packed into training windows of several sizes.

Each task tokenizes the documents of its split and packs them on the spot, so the
job is one map over the scan: no row of text is shuffled, and a lost executor costs
only its own splits.

* *Route.* A document is cut into windows of the longest tier as far as it goes; its
  tail goes to the smallest tier that can hold it.
* *Pack each tier.* A tail opens a window of its tier.
* *Fill.* What the tail leaves open is filled from shorter tiers, first with the next
  tail of the longest tier that fits; where none fits, a short one is cut and its rest
  routed anew.
* *End.* What is left when the split ends fills windows of falling powers of two, so
  no window has padding.
* *Step groups.* The windows of every tier are dealt in turn to the open groups, so
  that groups hold the same number of windows of each size, to one.

Rows: a null text is empty and holds the end id alone; a null id stays null; repeated
rows are packed as often as they occur; an empty table gives no pieces; other columns
of the input are not read.
"""

from __future__ import annotations

import array
import bisect
import os
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailspark.llm.common import same_schema, small_batches, text_slices

TIERS = (128, 256, 512, 1024)
END_ID = 0
OPEN_GROUPS = 8
STEP_TOKENS = 65_536
#: Words, and parts of words, whose ids a worker remembers; only speed depends on it.
REMEMBERED = 600_000
#: The bytes of an id: unsigned, little-endian.
ID_BYTES = 4

SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, "
    "sequence_id long, offset long, tier int, step_group long"
)
ARROW_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("tier", pa.int32()),
        ("step_group", pa.int64()),
    ]
)


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte.

    Fixed values: printable Latin-1 bytes stand for themselves, the others for the
    letters from 256 on.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Wide(Exception):
    """A space beside other white space, or an added token."""


class WordTokens(dict):
    """Ids of texts as bytes; a worker encodes each word once and remembers it here.

    The vocabulary's own pattern cuts a text into parts that are encoded one by one.  It
    never joins a part with a single space behind it, so the ids of a text are those of
    its words, each with the space before it.  Where a space stands beside other white
    space the pattern looks beyond it; such a text is encoded as a whole, and so is one
    that holds an added token.  With ``find_special`` special tokens are among these, as
    the library has it by default; without, their letters are text like any other.
    """

    def __init__(self, path: str, pattern: str, find_special: bool = False):
        import regex
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not find_special
        self.added = [
            t.content
            for t in self.tokenizer.get_added_tokens_decoder().values()
            if find_special or not t.special
        ]
        self.tokenize = self.tokenizer.model.tokenize
        self.parts_of = regex.compile(pattern).findall
        self.letters = byte_letters()
        self.parts: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        if word.isalpha():
            ids = self.encode_part(" " + word)
        elif not word or word[0].isspace() or word[-1].isspace():
            raise _Wide
        else:
            ids = b"".join(map(self.known_part, self.parts_of(" " + word)))
        self[word] = ids
        return ids

    def encode_part(self, part: str) -> bytes:
        found = self.tokenize(part.encode().decode("latin-1").translate(self.letters))
        return array.array("I", [t.id for t in found]).tobytes()

    def known_part(self, part: str) -> bytes:
        if part[0] == " " and part[1:].isalpha():
            return self[part[1:]]
        known = self.parts.get(part)
        if known is None:
            known = self.parts[part] = self.encode_part(part)
        return known

    def encode_text(self, text: str) -> bytes:
        first, *words = text.split(" ")
        try:
            if first[-1:].isspace() or any(t in text for t in self.added):
                raise _Wide
            return b"".join(map(self.known_part, self.parts_of(first))) + b"".join(
                map(self.__getitem__, words)
            )
        except _Wide:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return array.array("I", ids).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self) > REMEMBERED:
            self.clear()
        if len(self.parts) > REMEMBERED:
            self.parts.clear()
        return [self.encode_text(t) for t in texts]


class Packer:
    """Packs pieces (doc_id, start, ids, doc_tokens) that arrive one after the other."""

    def __init__(self, first_id: int, tiers: tuple[int, ...]):
        self.tiers = sorted(tiers)
        self.queues: list[list[tuple]] = [[] for _ in self.tiers]
        self.next_id = first_id
        self.group = first_id
        self.dealt = [0] * (len(self.tiers) + 1)
        self.tokens = 0
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        total, longest = len(ids) // ID_BYTES, self.tiers[-1]
        full = total - total % longest
        for start in range(0, full, longest):
            self.close([(doc_id, start, ids[ID_BYTES * start : ID_BYTES * (start + longest)], total)])
        if full < total:
            self.route((doc_id, full, ids[ID_BYTES * full :], total))

    def route(self, piece: tuple) -> None:
        self.queues[bisect.bisect_left(self.tiers, len(piece[2]) // ID_BYTES)].append(piece)

    def pack(self, at_end: bool) -> None:
        """Fill windows from the longest tier down while there are pieces for them."""
        waiting = sum(len(p[2]) for q in self.queues for p in q) // ID_BYTES
        for size, queue in reversed(list(zip(self.tiers, self.queues))):
            while queue and (at_end or waiting >= self.tiers[-1]) and waiting >= size:
                window, gap = [queue.pop()], size
                gap -= len(window[0][2]) // ID_BYTES
                while gap:
                    piece = self.filling(gap)
                    window.append(piece)
                    gap -= len(piece[2]) // ID_BYTES
                waiting -= size
                self.close(window)
        if at_end:
            self.rest()

    def filling(self, gap: int) -> tuple:
        """The largest waiting piece of a tier that fits, or a part of a short one."""
        for queue in reversed(self.queues):
            if queue and len(queue[-1][2]) <= gap * ID_BYTES:
                return queue.pop()
        doc_id, start, ids, total = next(q for q in self.queues if q).pop()
        self.route((doc_id, start + gap, ids[ID_BYTES * gap :], total))
        return doc_id, start, ids[: ID_BYTES * gap], total

    def rest(self) -> None:
        left = [p for q in reversed(self.queues) for p in q]
        for q in self.queues:
            q.clear()
        waiting = sum(len(p[2]) for p in left) // ID_BYTES
        while waiting:
            gap = 1 << (waiting.bit_length() - 1)
            waiting -= gap
            window = []
            while gap:
                doc_id, start, ids, total = left.pop(0)
                taken, kept = ids[: ID_BYTES * gap], ids[ID_BYTES * gap :]
                if kept:
                    left.insert(0, (doc_id, start + gap, kept, total))
                window.append((doc_id, start, taken, total))
                gap -= len(taken) // ID_BYTES
            self.close(window)

    def close(self, window: list[tuple]) -> None:
        offset, size = 0, sum(len(p[2]) for p in window) // ID_BYTES
        tier = bisect.bisect_left(self.tiers, size)
        group = self.group + self.dealt[tier] % OPEN_GROUPS
        for doc_id, start, ids, total in window:
            n = len(ids) // ID_BYTES
            self.rows.append(
                (doc_id, start, n, ids, total, self.next_id, offset, self.tiers[tier], group)
            )
            offset += n
        self.next_id += 1
        self.dealt[tier] += 1
        self.tokens += size
        if self.tokens >= OPEN_GROUPS * STEP_TOKENS:
            self.group += OPEN_GROUPS
            self.dealt = [0] * len(self.dealt)
            self.tokens = 0

    def taken(self) -> pa.RecordBatch:
        columns = zip(*self.rows) if self.rows else ([] for _ in ARROW_SCHEMA)
        self.rows = []
        return same_schema(dict(zip(ARROW_SCHEMA.names, map(list, columns))), ARROW_SCHEMA)


def pack(
    docs: DataFrame,
    tokenizer: str,
    pattern: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    tiers: tuple[int, ...] = TIERS,
    find_special: bool = False,
) -> DataFrame:
    """One row per piece with its ids (as unsigned little-endian 32-bit numbers).

    ``tokenizer`` is the path of a byte-level BPE file that every executor has, and
    ``pattern`` the one by which that vocabulary cuts texts.  With ``find_special`` the
    name of a special token in a text gets that token's id, otherwise those of its letters.
    """
    if any(t & (t - 1) for t in tiers):
        raise ValueError("tiers must be powers of two")

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = worker_tokens(tokenizer, pattern, find_special).encode
        packer = Packer(TaskContext.get().partitionId() << 32, tiers)
        end = END_ID.to_bytes(ID_BYTES, "little")
        for rows, texts in text_slices(batches, "text"):
            for doc_id, ids in zip(rows.column("doc_id").to_pylist(), encode(texts)):
                packer.add(doc_id, ids + end)
            packer.pack(at_end=False)
            yield packer.taken()
        packer.pack(at_end=True)
        yield packer.taken()

    return small_batches(docs).select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    ).mapInArrow(packed, SCHEMA)


_TOKENS: dict[tuple, WordTokens] = {}


def worker_tokens(path: str, pattern: str, find_special: bool = False) -> WordTokens:
    """One vocabulary and one memory of words per Python worker."""
    key = path, pattern, find_special
    if key not in _TOKENS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _TOKENS[key] = WordTokens(*key)
    return _TOKENS[key]
