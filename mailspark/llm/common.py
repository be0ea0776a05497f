"""Helpers that the operators of this package share."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python step holds at a time, besides the batch it came in.
SLICE_BYTES = 1 << 20

#: The white space and the words of every contract, as patterns and as Python's own
#: split of bytes sees them.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


#: Rows that go to a Python worker at a time, unless the session says otherwise.  Spark's
#: default is fit for short rows; of texts it is tens of megabytes, held several times.
ROWS_AT_ONCE = 500
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(docs: DataFrame) -> DataFrame:
    """The same rows; the session sends fewer at a time to Python, if it has the default."""
    conf = docs.sparkSession.conf
    if conf.get(_BATCH_ROWS) == "10000":
        conf.set(_BATCH_ROWS, str(ROWS_AT_ONCE))
    return docs


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


def text_slices(
    batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Runs of rows that hold about ``limit`` bytes of text, or one longer row.

    Yields the rows and their texts; a null text is an empty one.
    """
    for batch in batches:
        texts = pc.fill_null(batch.column(column), "")
        sizes = pc.binary_length(texts).to_pylist()
        start = size = 0
        for i, n in enumerate(sizes):
            if i > start and size + n > limit:
                yield batch.slice(start, i - start), texts.slice(start, i - start).to_pylist()
                start, size = i, 0
            size += n
        if len(sizes) > start:
            yield batch.slice(start), texts.slice(start).to_pylist()
    # Workers outlive their tasks; what Arrow holds back is for others now.
    pa.default_memory_pool().release_unused()


def same_schema(rows: dict[str, object], like: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            v.cast(f.type) if isinstance(v, pa.Array) else pa.array(v, f.type)
            for f, v in ((f, rows[f.name]) for f in like)
        ],
        schema=like,
    )


def hex_sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


_GAP = re.compile(rb"[\x20\x09-\x0D]")


def word_chunks(data: bytes, size: int = SLICE_BYTES) -> Iterator[list[bytes]]:
    """The words of a text, some at a time: lists from about ``size`` bytes each."""
    at = 0
    while at < len(data):
        gap = _GAP.search(data, at + size)
        end = gap.start() if gap else len(data)
        yield data[at:end].split()
        at = end
