"""Mails in blocks, each with a dictionary of its own.

Weights of terms are needed where mails are, and a vocabulary fits nowhere as a whole.  A
*block* is a run of mails with a bounded number of cells.  Its mails hold numbers of the
block's terms, and its dictionary has a row per term.  Vocabularies and weights are joined
to dictionaries, and a block's task looks the cells up in its own: what is shuffled is
every term once per block, not once per mail, and no mail's id goes with a term.

A dictionary is written as *shares*: its terms are dealt by a hash of theirs, and those of a
share are packed, in order, into one value.  Who counts a term over all blocks shuffles the
shares; ``terms`` unpacks them.

Mails are dealt and ordered by id before their text is cut into terms, so rows that share
an id are neighbours in one block; their cells count as those of one mail.  Mails of
different folds are in different blocks, so a block needs the weights of one view only.

Rows: null ids are equal to each other; a mail without terms is in a block all the same.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import count
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailspark.config import FeatureConfig
from mailspark.functions.terms import count_terms, ngrams_of_word, term_documents, word_documents
from mailspark.sources.scratch import DENSE, scratch_path

#: Cells of a block at most, unless one mail has more; results don't depend on it.
CELLS_PER_BLOCK = 4_000_000
#: Shares of a dictionary that leave a task at a time, and mails that come in.
SHARES_AT_ONCE, MAILS_AT_ONCE = 100, 500
#: Shares that terms are dealt to at least; there are as many as shuffle partitions if those
#: are more.  Results don't depend on it.
SHARES = 256
#: Of compression: shares are large, and packed once.
_LEVEL = 9
#: What columns with numbers of terms begin with; the rest names the fit that gave them.
TERM = "term_"
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_CODEC = "zstd"
_OWN = {
    "block": "long", "cells": "int", "codes": "binary", "counts": "binary",
    "share": "int", "n_terms": "int", "n_bytes": "int", "packed": "binary",
}


@dataclass(frozen=True)
class Blocks:
    """``mails`` has block, the mails' own columns and their packed cells; ``terms`` has
    block, fold, code, token and df, the mails of the block that hold the term.  ``shares``
    are the dictionaries as written; there are none where ``terms`` were changed."""

    mails: DataFrame
    terms: DataFrame
    shares: DataFrame | None = None

    @property
    def kept(self) -> list[str]:
        return [c for c in self.mails.columns if c not in _OWN]

    def where(self, of_fold: Column) -> "Blocks":
        """The blocks of some folds."""
        mails = self.mails.where(of_fold)
        return Blocks(mails, self.terms.where(of_fold)) if self.shares is None else _of_shares(mails, self.shares.where(of_fold))

    def train(self) -> "Blocks":
        """The blocks that train, with the columns that models are fitted on."""
        blocks = self.where(F.col("fold").isNotNull())
        mails = blocks.mails.select("block", "id", "label", "fold", "cells", "codes", "counts")
        return Blocks(mails, blocks.terms, blocks.shares)


def mail_blocks(mails: DataFrame, config: FeatureConfig) -> Blocks:
    """Mails (id, text, …) as blocks; texts are dealt by id, which moves no term.

    Character n-grams lie within words, so a mail's words are counted, and a block cuts each of
    its words once.
    """
    if config.analyzer == "char_wb":
        return _coded(count_terms(word_documents(_by_id(mails))), (config.min_n, config.max_n))
    return _coded(count_terms(term_documents(_by_id(mails), config)))


def term_blocks(docs: DataFrame | Blocks) -> Blocks:
    """Term documents (id, …, terms) as blocks, unless they are."""
    return docs if isinstance(docs, Blocks) else _coded(_by_id(docs))


def _by_id(rows: DataFrame) -> DataFrame:
    """Dealt by fold and id: a task has mails of few folds, so its blocks are few and large."""
    dealt = rows.repartitionByRange("fold", "id") if "fold" in rows.columns else rows.repartition("id")
    return dealt.sortWithinPartitions("id")


def _coded(docs: DataFrame, ngrams: tuple[int, int] | None = None) -> Blocks:
    """Ordered term documents as blocks, written once; with ``ngrams``, the least and the greatest
    length, the terms are the character n-grams of the counted words."""
    if "fold" not in docs.columns:
        docs = docs.withColumn("fold", F.lit(None).cast("int"))
    conf = docs.sparkSession.conf
    if conf.get(_BATCH_ROWS) == "10000":  # of mails with their terms, hundreds of megabytes
        conf.set(_BATCH_ROWS, str(MAILS_AT_ONCE))
    kept = [c for c in docs.columns if c != "terms"]
    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept]
    fields += [f"{name} {kind}" for name, kind in _OWN.items()]
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "blocks")
    n_shares = max(SHARES, int(conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(*kept, "terms").mapInArrow(_coder(kept, n_shares, ngrams), ", ".join(fields))
    rows.write.parquet(path, compression=DENSE)
    # Read twice, so that the tables share no columns and can be joined.
    mails, shares = (spark.read.schema(rows.schema).parquet(path) for _ in range(2))
    names = ["block", "fold", "share", "n_terms", "n_bytes", "packed"]
    return _of_shares(
        mails.where(F.col("share").isNull()).drop(*names[2:]), shares.where(F.col("share").isNotNull()).select(names)
    )


def _of_shares(mails: DataFrame, shares: DataFrame) -> Blocks:
    fold = shares.schema["fold"].dataType.simpleString()

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                tokens, codes, df = unpacked(one)
                columns = [one.column(c).take(pa.array(np.zeros(len(tokens), np.int32))) for c in ("block", "fold")]
                columns += [pa.array(codes), tokens, pa.array(df)]
                yield pa.RecordBatch.from_arrays(columns, ["block", "fold", "code", "token", "df"])

    terms = shares.mapInArrow(work, f"block long, fold {fold}, code int, token string, df int")
    return Blocks(mails, terms, shares)


def unpacked(shares: pa.RecordBatch | pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The tokens, codes and df of shares, one after the other."""
    tokens, numbers = [], [np.zeros((3, 0), np.int32)]
    for n, size, data in zip(*(shares.column(c).to_pylist() for c in ("n_terms", "n_bytes", "packed"))):
        raw = pa.decompress(data, size, _CODEC, asbytes=True)
        planes = np.frombuffer(raw, np.uint8, 12 * n).reshape(3, 4, n)
        numbers.append(np.ascontiguousarray(planes.transpose(0, 2, 1)).view(np.int32)[..., 0])
        ends = np.concatenate([[0], np.cumsum(numbers[-1][0])]).astype(np.int32)
        tokens.append(pa.StringArray.from_buffers(n, pa.py_buffer(ends), pa.py_buffer(raw[12 * n :])))
    _, codes, df = np.concatenate(numbers, axis=1)
    return pa.concat_arrays([pa.array([], pa.string()), *tokens]), codes, df


def _packed(tokens: pa.Array, codes: np.ndarray, df: np.ndarray) -> tuple[int, bytes]:
    """Bytes before compression, and compressed: lengths of tokens, codes and df by place
    of their bytes, for most of these are alike, then the tokens."""
    numbers = np.stack([pc.binary_length(tokens).to_numpy(), codes, df]).astype(np.int32)
    planes = numbers.view(np.uint8).reshape(3, len(tokens), 4).transpose(0, 2, 1)
    raw = planes.tobytes() + "".join(tokens.to_pylist()).encode()
    return len(raw), pa.Codec(_CODEC, compression_level=_LEVEL).compress(raw, asbytes=True)


def _coder(kept: list[str], n_shares: int, ngrams: tuple[int, int] | None = None):
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = count(TaskContext.get().partitionId() << 32)
        waiting: dict[int | None, list[pa.RecordBatch]] = {}
        sizes: dict[int | None, int] = {}
        coded: dict[int | None, list[_Coded]] = {}

        def closed(fold: int | None) -> Iterator[pa.RecordBatch]:
            """What waits is coded, and makes a block with what was coded before, as far as they fit."""
            new = _Coded.of(waiting.pop(fold), kept, ngrams)
            sizes[fold] = 0
            before = coded.setdefault(fold, [])
            if before and sum(len(c.places) for c in before) + len(new.places) > CELLS_PER_BLOCK:
                yield from _block(next(numbers), coded.pop(fold), kept, n_shares)
            coded.setdefault(fold, []).append(new)
            if ngrams is None:  # as many cells as were counted
                yield from _block(next(numbers), coded.pop(fold), kept, n_shares)

        for batch in batches:
            for fold, rows in _by_fold(batch):
                cells = _cells_in(rows, ngrams)
                full = sizes.get(fold, 0) + cells > CELLS_PER_BLOCK
                if full and waiting.get(fold) and _last_id(waiting[fold]) != rows.column("id")[0].as_py():
                    yield from closed(fold)
                waiting.setdefault(fold, []).append(rows)
                sizes[fold] = sizes.get(fold, 0) + cells
        for fold in list(waiting):
            yield from closed(fold)
        for parts in coded.values():
            yield from _block(next(numbers), parts, kept, n_shares)
        pa.default_memory_pool().release_unused()

    return work


def _last_id(batches: list[pa.RecordBatch]):
    return batches[-1].column("id")[-1].as_py()


def _by_fold(batch: pa.RecordBatch) -> Iterator[tuple[int | None, pa.RecordBatch]]:
    folds = batch.column("fold")
    for fold in folds.unique().to_pylist():
        wanted = folds.is_null() if fold is None else pc.fill_null(pc.equal(folds, fold), False)
        rows = batch.filter(wanted)
        if rows.num_rows:
            yield fold, rows


def _cells_in(rows: pa.RecordBatch, ngrams: tuple[int, int] | None) -> int:
    """Cells of some mails; at most so many if they are n-grams of the mails' words."""
    terms = rows.column("terms").flatten()
    if ngrams is None or not len(terms):
        return len(terms)
    letters = pc.utf8_length(terms.field("token")).to_numpy().astype(np.int64)
    least, most = ngrams
    sizes = letters + 2
    fits = [np.where((sizes >= n) | (n == least), np.maximum(sizes - n + 1, 1), 0) for n in range(least, most + 1)]
    return int(sum(f.sum() for f in fits))


def _cut(
    sizes: np.ndarray, indices: np.ndarray, words: pa.Array, counts: np.ndarray, ngrams: tuple[int, int]
) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """The n-grams of mails' words, as sizes, places and counts of the mails' cells: each word is cut
    once, and some mails' n-grams are added up at a time."""
    found = [ngrams_of_word(word, *ngrams) for word in words.to_pylist()]
    of_word = np.array([len(f) for f in found], np.int64)
    coded = pa.array([gram for f in found for gram in f], pa.string()).dictionary_encode()
    del found
    grams, tokens = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    first, width = np.cumsum(of_word) - of_word, max(1, len(tokens))
    spans = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    parts: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(3)]
    for at in range(0, len(sizes), MAILS_AT_ONCE):
        some = sizes[at : at + MAILS_AT_ONCE]
        cells = slice(spans[at], spans[at + len(some)])
        n = of_word[indices[cells]]
        ends = np.cumsum(n)
        places = np.repeat(first[indices[cells]] - (ends - n), n) + np.arange(int(n.sum()))
        keys = np.repeat(np.repeat(np.arange(len(some)), some) * width, n) + grams[places]
        order = np.argsort(keys)
        keys = keys[order]
        new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        tf = np.add.reduceat(np.repeat(counts[cells], n)[order], new) if len(new) else np.zeros(0, np.int64)
        keys = keys[new]
        for to, values in zip(parts, (np.bincount(keys // width, minlength=len(some)), keys % width, tf)):
            to.append(values)
    new_sizes, places, tf = (np.concatenate(p) for p in parts)
    return new_sizes, places.astype(np.int32), tokens, tf.astype(np.int32)


@dataclass(frozen=True)
class _Coded:
    """Some mails, and the number, places in ``tokens`` and counts of their cells."""

    mails: pa.Table
    sizes: np.ndarray
    places: np.ndarray
    tokens: pa.Array
    counts: np.ndarray

    @staticmethod
    def of(batches: list[pa.RecordBatch], kept: list[str], ngrams: tuple[int, int] | None) -> _Coded:
        sizes = np.concatenate([pc.fill_null(b.column("terms").value_lengths(), 0).to_numpy() for b in batches])
        cells = pa.chunked_array([b.column("terms").flatten() for b in batches]).combine_chunks()
        cells = cells if isinstance(cells, pa.StructArray) else pa.concat_arrays(cells.chunks)
        found = cells.field("token").dictionary_encode()
        places, tokens = found.indices.to_numpy(), found.dictionary
        counts = cells.field("tf").to_numpy().astype(np.int32)
        if ngrams is not None:
            sizes, places, tokens, counts = _cut(sizes, places, tokens, counts, ngrams)
        return _Coded(pa.Table.from_batches(batches).select(kept), sizes, places, tokens, counts)


def _joined(parts: list[_Coded]) -> _Coded:
    """Parts as one, with one dictionary."""
    if len(parts) == 1:
        return parts[0]
    found = pa.concat_arrays([p.tokens for p in parts]).dictionary_encode()
    ends = np.cumsum([len(p.tokens) for p in parts])
    codes = np.split(found.indices.to_numpy(), ends[:-1])
    sizes, counts = (np.concatenate(c) for c in ([p.sizes for p in parts], [p.counts for p in parts]))
    places = np.concatenate([code[p.places] for code, p in zip(codes, parts)])
    return _Coded(pa.concat_tables([p.mails for p in parts]), sizes, places, found.dictionary, counts)


def _block(number: int, parts: list[_Coded], kept: list[str], n_shares: int) -> Iterator[pa.RecordBatch]:
    """A block's mails, then the shares of its dictionary; the commonest terms have the lowest numbers."""
    x = _joined(parts)
    mails, sizes, indices, tokens, counts = x.mails.combine_chunks(), x.sizes, x.places, x.tokens, x.counts
    df = np.bincount(indices, minlength=len(tokens))
    common = np.argsort(-df, kind="stable")
    rank = np.empty(len(tokens), np.int64)
    rank[common] = np.arange(len(tokens))
    mail = np.repeat(np.arange(len(mails)), sizes)
    order = np.argsort(mail * max(1, len(tokens)) + rank[indices])
    codes, counts = rank[indices][order], counts[order]
    ends = np.cumsum(sizes)
    starts = ends - sizes
    steps = np.diff(codes, prepend=0)
    first = starts[sizes > 0]
    steps[first] = codes[first]
    steps, counts = steps.astype(np.int32).tobytes(), counts.tobytes()
    spans = [(4 * int(a), 4 * int(b)) for a, b in zip(starts, ends)]
    columns = [mails.column(c).combine_chunks() for c in kept]
    columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns]
    own = {
        "block": pa.array(np.full(len(mails), number)),
        "cells": pa.array(sizes.astype(np.int32)),
        "codes": pa.array([pa.compress(steps[a:b], _CODEC, asbytes=True) for a, b in spans], pa.binary()),
        "counts": pa.array([pa.compress(counts[a:b], _CODEC, asbytes=True) for a, b in spans], pa.binary()),
        **_nulls(len(mails), "share", "n_terms", "n_bytes", "packed"),
    }
    yield pa.RecordBatch.from_arrays([*columns, *own.values()], [*kept, *own])
    fold, types = mails.column("fold")[0].as_py(), {c: mails.schema.field(c).type for c in kept}
    shares = np.array([crc32(t.encode()) % n_shares for t in tokens.to_pylist()], np.int64)
    in_order = pc.sort_indices(tokens).to_numpy()
    in_order = in_order[np.argsort(shares[in_order], kind="stable")]
    tokens, df, codes = tokens.take(pa.array(in_order)), df[in_order], rank[in_order]
    found, starts = np.unique(shares[in_order], return_index=True)
    ends = np.append(starts, len(tokens))[1:]
    for at in range(0, len(found), SHARES_AT_ONCE):
        some = [slice(int(a), int(b)) for a, b in zip(starts[at : at + SHARES_AT_ONCE], ends[at : at + SHARES_AT_ONCE])]
        packed = [_packed(tokens[x], codes[x], df[x]) for x in some]
        n = len(some)
        empty = [pa.array([fold] * n, t) if c == "fold" else pa.nulls(n, t) for c, t in types.items()]
        own = {
            "block": pa.array(np.full(n, number)),
            **_nulls(n, "cells", "codes", "counts"),
            "share": pa.array(found[at : at + n].astype(np.int32)),
            "n_terms": pa.array([x.stop - x.start for x in some], pa.int32()),
            "n_bytes": pa.array([size for size, _ in packed], pa.int32()),
            "packed": pa.array([data for _, data in packed], pa.binary()),
        }
        yield pa.RecordBatch.from_arrays([*empty, *own.values()], [*kept, *own])


def _nulls(n: int, *names: str) -> dict[str, pa.Array]:
    return {c: pa.nulls(n, pa.int32() if _OWN[c] == "int" else pa.binary()) for c in names}


# --- work in a block ------------------------------------------------------------


@dataclass(frozen=True)
class Cells:
    """The cells of a block that its dictionary knows: the group of mails that share an id,
    the dictionary's row and the scaled count of each; ``mail`` is the row in ``mails``."""

    mails: pa.Table
    terms: pa.Table
    mail: np.ndarray
    group: np.ndarray
    groups: np.ndarray
    row: np.ndarray
    tf: np.ndarray

    def column(self, name: str) -> np.ndarray:
        """A column of the dictionary by row; null as not a number."""
        return self.terms.column(name).to_numpy(zero_copy_only=False).astype(float)

    def lengths(self, weights: np.ndarray, config: FeatureConfig) -> np.ndarray:
        """The length of each group's vector, given the weights of the cells."""
        if not config.l2_norm:
            return np.ones(len(self.groups))
        return np.sqrt(np.bincount(self.group, weights * weights, len(self.groups)))


def cells_of(mails: pa.Table, terms: pa.Table, config: FeatureConfig) -> Cells:
    mails = mails.combine_chunks().sort_by("id")
    ids = mails.column("id").combine_chunks()
    sizes = mails.column("cells").to_numpy().astype(np.int64)
    coded = dict(zip(("codes", "counts"), ([], [])))
    for name, parts in coded.items():
        for n, data in zip(sizes.tolist(), mails.column(name).to_pylist()):
            if n:
                parts.append(np.frombuffer(pa.decompress(data, 4 * n, _CODEC, asbytes=True), np.int32))
    none = np.zeros(0, np.int32)
    codes = np.concatenate([none, *(np.cumsum(c, dtype=np.int64) for c in coded["codes"])]).astype(np.int64)
    counts = np.concatenate([none, *coded["counts"]])
    mail = np.repeat(np.arange(len(mails)), sizes)
    coded_ids = ids.dictionary_encode(null_encoding="encode") if len(mails) else None
    numbers = coded_ids.indices.to_numpy() if len(mails) else none
    new = np.concatenate([[True], numbers[1:] != numbers[:-1]]) if len(mails) else np.zeros(0, bool)
    group = np.cumsum(new) - 1
    known = terms.column("code").to_numpy() if len(terms) else none
    place = np.full(max(int(codes.max(initial=-1)), int(known.max(initial=-1))) + 1, -1)
    place[known] = np.arange(len(known))
    row = place[codes]
    inside = np.flatnonzero(row >= 0)
    tf = counts[inside].astype(float)
    if config.sublinear_tf:
        tf = 1.0 + np.log(tf)
    return Cells(mails, terms, mail[inside], group[mail[inside]], np.flatnonzero(new), row[inside], tf)


def number_order(x: Cells, numbers: np.ndarray) -> np.ndarray:
    """The cells by group and by the numbers of their terms; mails without an id have none."""
    named = x.mails.column("id").is_valid().to_numpy()
    cells = np.flatnonzero(named[x.mail])
    numbers = numbers[x.row[cells]].astype(np.int64)
    return cells[np.argsort(x.group[cells] * (numbers.max(initial=0) + 1) + numbers, kind="stable")]


def with_lists(x: Cells, cells: np.ndarray, kept: list[str], columns: dict[str, np.ndarray]) -> pa.Table:
    """The mails of a block with columns of the given cells, which are in order of group, as lists."""
    sizes = np.bincount(x.group[cells], minlength=len(x.groups))
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    shared = np.repeat(np.arange(len(x.groups)), np.diff(np.append(x.groups, len(x.mails))))
    found = x.mails.select(kept)
    for name, values in columns.items():
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
        found = found.append_column(name, lists if len(lists) == len(found) else lists.take(pa.array(shared)))
    return found


def vector_rows(
    blocks: Blocks, kept: list[str], vocab: DataFrame, work, lists: dict[str, str]
) -> DataFrame:
    """The mails of blocks with list columns that ``work`` makes of a block's mails and its rows
    of ``vocab`` (token, index, …): no cell is shuffled."""
    held = blocks.terms.select("block", "code", "token").join(vocab, "token").drop("token")
    fields = [f"`{c}` {blocks.mails.schema[c].dataType.simpleString()}" for c in kept]
    fields += [f"{name} {kind}" for name, kind in lists.items()]
    mails = blocks.mails.select("block", *kept, "cells", "codes", "counts")
    return mails.groupBy("block").cogroup(held.groupBy("block")).applyInArrow(work, ", ".join(fields))


def block_sums(
    blocks: Blocks, table: DataFrame, idf: Column, weights: dict[str, Column], config: FeatureConfig
) -> DataFrame:
    """What ``linear_sums`` gives for the mails of blocks.

    ``idf`` and ``weights`` may use columns of ``table`` and ``fold``.  Where both have the
    numbers of terms that one fit gave them, these are joined and not the terms.
    """
    numbers = [c for c in table.columns if c.startswith(TERM) and c in blocks.terms.columns]
    key = numbers[0] if numbers else "token"
    held = blocks.terms.select("block", "fold", "code", key).join(table, key).select(
        "block", "code", idf.alias("_idf"), *[w.cast("double").alias(n) for n, w in weights.items()]
    ).where(F.col("_idf").isNotNull())
    kept, names = blocks.kept, list(weights)

    def work(mails: pa.Table, terms: pa.Table) -> pa.Table:
        x = cells_of(mails, terms, config)
        w = x.tf * x.column("_idf")[x.row]
        length = x.lengths(w, config)
        first = x.mails.select(kept).take(pa.array(x.groups))
        for name in names:
            dot = np.bincount(x.group, w * np.nan_to_num(x.column(name)[x.row]), len(x.groups))
            first = first.append_column(name, pa.array(np.divide(dot, length, out=np.zeros_like(dot), where=length > 0)))
        return first

    schema = [f"`{c}` {blocks.mails.schema[c].dataType.simpleString()}" for c in kept]
    return (
        blocks.mails.groupBy("block")
        .cogroup(held.groupBy("block"))
        .applyInArrow(work, ", ".join([*schema, *(f"{n} double" for n in names)]))
    )


def term_products(
    blocks: Blocks, table: DataFrame, factors: DataFrame, name: str, config: FeatureConfig
) -> DataFrame:
    """token and in column ``name`` the sum over the mails of the term's weight in the mail's
    vector times the mail's factor; ``table`` has token and idf, ``factors`` id and ``name``."""
    held = blocks.terms.select("block", "code", "token").join(table.select("token", "idf"), "token")
    mails = blocks.mails.select("block", "id", "cells", "codes", "counts").join(factors.select("id", name), "id")

    def work(mails: pa.Table, terms: pa.Table) -> pa.Table:
        x = cells_of(mails, terms, config)
        w = x.tf * x.column("idf")[x.row]
        factor = x.mails.column(name).to_numpy()[x.mail]
        sums = np.bincount(x.row, w / x.lengths(w, config)[x.group] * factor, len(terms))
        return pa.table({"token": terms.column("token"), name: pa.array(sums)})

    sums = mails.groupBy("block").cogroup(held.groupBy("block")).applyInArrow(work, f"token string, {name} double")
    return sums.groupBy("token").agg(F.sum(name).alias(name))
