"""Rows that every operator must get through, and a table of them."""

from pyspark.sql import types as T

LONG = "lorem ipsum dolor " * 30_000

#: (doc_id, text): null and repeated ids and rows, null, blank, long and odd texts.
EDGE = [
    (1, "the quick brown fox jumps over the lazy dog"),
    (1, "the quick brown fox jumps over the lazy dog"),
    (1, "another text under the same id"),
    (2, None),
    (3, ""),
    (4, " \t\n\x0b\x0c\r "),
    (5, LONG),
    (6, LONG),
    (None, "the quick brown  fox\njumps over the lazy dog"),
    (None, None),
    (7, "é ü 日本語 😀 \x00   á"),
    (8, "<|endoftext|> <s> </s> 12:30 #*$%&|<>"),
]

#: Names that operators use themselves.
CLASHES = (
    "row", "key", "ord", "name", "doc", "spans", "start", "score", "lang_pred", "kept",
    "text_key", "fp", "component", "host", "segments", "ids", "live", "owner",
)


def table(spark, rows, text="text", more=()):
    """doc_id, the text, lang, source, n_chars and columns with clashing names."""
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField(text, T.StringType()),
            T.StructField("lang", T.StringType()),
            T.StructField("source", T.StringType()),
            T.StructField("n_chars", T.LongType()),
            *(T.StructField(c, T.StringType()) for c in CLASHES if c != text),
        ]
    )
    full = [
        (i, t, "en" if n % 3 else None, f"s{n % 4}" if n % 5 else None, None if t is None else len(t))
        + tuple(f"{c}{n}" for c in CLASHES if c != text)
        for n, (i, t) in enumerate([*rows, *more])
    ]
    return spark.createDataFrame(full, schema)


def empty(spark, text="text"):
    return table(spark, [], text).limit(0)
