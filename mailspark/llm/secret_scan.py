"""Secrets in texts, told from widely copied examples by who holds them.

Candidates are matches of fixed patterns.  Spark gives the texts of all matches and
the texts between them; the lengths of both, summed up along a text, are the places.
Candidates' values are hashed, and the distinct repositories and owners of every hash
are counted over the whole corpus.  A value of one or two owners is live-looking, in
however many of their repositories it stands.  One that ``WIDE_OWNERS`` hold is an example
that was copied around, and so is one of ``SOME_OWNERS`` or more that stands in
``COPIED`` repositories for each of them on average.

The kinds ``assign``, ``access`` and ``hex`` are reported in any case, each with the
verdict on its value.  The kind ``owned`` is added by the counts: a long token of mixed
letters and digits outside all other spans, when it is live-looking.

Only texts that hold a candidate are written, exploded and joined; the others pass in
one scan.  Everything runs as DataFrame and SQL functions.

Rows: a null text is empty and has no spans; a null owner or repository is one of its
own, shared by all such rows; rows that repeat an id are scanned and returned each;
an empty table gives no rows.  Names of the input's other columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailspark.sources.scratch import written

# Patterns of the contract.
ASSIGN = (
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
    r"([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_VALUE = 12

OWNED = r"[A-Za-z0-9+/_-]{20,}"
#: An owned token has at least so many different characters, letters and digits.
DIFFERENT = 8
#: Values held by as many owners are examples, and those held by some owners of which each
#: has them in so many repositories.
WIDE_OWNERS = 5
SOME_OWNERS = 3
COPIED = 10

KINDS = ("assign", "access", "hex", "owned")
PATTERNS = {"assign": (ASSIGN, 2), "access": (ACCESS, 0), "hex": (HEX, 0), "owned": (OWNED, 0)}
#: Every text with a span of any kind matches this.
ANY = (
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{12}"
    r"|AKIA[A-Z0-9]{14}|[0-9a-f]{16}|[A-Za-z0-9+/_-]{20}"
)
MASK = "[SECRET]"


def _matches(text: Column, kind: str) -> Column:
    """An array of all matches of a kind: order, text before, text, value."""
    pattern, group = PATTERNS[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    before = F.split(text, pattern, -1)
    parts = F.arrays_zip(
        F.transform(found, F.length).alias("length"),
        F.transform(F.slice(before, 1, F.size(found)), F.length).alias("gap"),
        values.alias("value"),
    )
    return F.transform(
        parts,
        lambda p, i: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"),
            i.alias("at"),
            p["gap"].alias("gap"),
            p["length"].alias("length"),
            p["value"].alias("value"),
        ),
    )


def candidates(hits: DataFrame) -> DataFrame:
    """Spans of ``hits`` (row, text, repository, owner): row, kind, start, stop, value, ..."""
    found = hits.select(
        "row",
        "repository",
        "owner",
        F.explode(F.concat(*(_matches(F.col("text"), k) for k in KINDS))).alias("m"),
    ).select("row", "repository", "owner", "m.*")
    along = Window.partitionBy("row", "kind").orderBy("at")
    value = F.col("value")
    mixed = (
        value.rlike("[0-9]")
        & value.rlike("[A-Za-z]")
        & (F.size(F.array_distinct(F.split(value, ""))) >= DIFFERENT)
    )
    placed = (
        found.withColumn("stop", F.sum(F.col("gap") + F.col("length")).over(along))
        .withColumn("start", F.col("stop") - F.col("length"))
        .where(
            F.when(F.col("kind") == 0, F.length(value) >= ASSIGN_VALUE)
            .when(F.col("kind") == 3, mixed)
            .otherwise(True)
        )
    )
    # A token overlaps a span of another kind if, of those that begin before its end,
    # one ends after its start.
    owned = F.col("kind") == 3
    along = (
        Window.partitionBy("row")
        .orderBy(F.when(owned, F.col("stop")).otherwise(F.col("start")), F.col("kind").desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    reach = F.max(F.when(~owned, F.col("stop"))).over(along)
    return (
        placed.withColumn("reach", F.coalesce(reach, F.lit(0)))
        .where(~owned | (F.col("reach") <= F.col("start")))
        .select(
            "row",
            "kind",
            "start",
            "stop",
            "value",
            F.sha2(value.cast("binary"), 256).alias("hash"),
            "repository",
            "owner",
        )
    )


def ownership(spans: DataFrame) -> DataFrame:
    """Of every candidate hash: its distinct owners and repositories, and the verdict."""
    return (
        spans.select("hash", "owner", "repository")
        .distinct()
        .groupBy("hash")
        .agg(
            F.countDistinct("owner").alias("owners"),
            F.countDistinct("repository").alias("repositories"),
        )
        .withColumn(
            "live",
            (F.col("owners") < WIDE_OWNERS)
            & (
                (F.col("owners") < SOME_OWNERS)
                | (F.col("repositories") < COPIED * F.col("owners"))
            ),
        )
    )


def _has_candidate(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(ANY)


def _holder(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def _judged(hits: DataFrame) -> DataFrame:
    """Spans of the rows with candidates (row, text, repository, owner), with the verdict."""
    spans = written(candidates(hits), "secret-spans")
    live = ownership(spans)
    return spans.join(live.select("hash", "live"), "hash").where(
        (F.col("kind") != 3) | F.col("live")
    )


def find_secrets(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    owner_column: str = "source",
    repository_column: str = "doc_id",
) -> DataFrame:
    """One row per row: doc_id and spans, an array of (start, kind, stop, hash, live).

    Spans are in order of start, then kind (a place in ``KINDS``); places are code points.
    """
    docs = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).cast("string").alias("text"),
        F.col(owner_column).cast("string").alias("owner"),
        F.col(repository_column).cast("string").alias("repository"),
    )
    # Each text is searched for candidates once; those without any leave their id only.
    hit = F.struct("text", _holder("repository").alias("repository"), _holder("owner").alias("owner"))
    rows = written(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.when(_has_candidate(F.col("text")), hit).alias("hit"),
        ),
        "secret-rows",
    )
    judged = _judged(rows.where(F.col("hit").isNotNull()).select("row", "hit.*"))
    spans = judged.groupBy("row").agg(
        F.array_sort(
            F.collect_list(F.struct("start", "kind", "stop", "hash", "live"))
        ).alias("spans")
    )
    none = F.array().cast(spans.schema["spans"].dataType)
    return rows.select("row", "doc_id").join(spans, "row", "left").select(
        "doc_id", F.coalesce("spans", none).alias("spans")
    )


def mask_secrets(
    docs: DataFrame,
    text_column: str = "text",
    owner_column: str = "source",
    repository_column: str = "doc_id",
    length_column: str | None = None,
) -> DataFrame:
    """The same rows and columns; live-looking values in the text are replaced by a mask.

    Examples stay.  Rows without a live-looking value are returned as they are.  In the
    others ``length_column`` gets the new length of the text in code points.
    """
    text = F.col(text_column)
    hits = written(
        docs.where(_has_candidate(text)).select(
            F.monotonically_increasing_id().alias("row"),
            F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"),
            text.alias("text"),
            _holder(repository_column).alias("repository"),
            _holder(owner_column).alias("owner"),
        ),
        "secret-hits",
    )
    judged = _judged(hits)
    values = (
        judged.where("live")
        .groupBy("row")
        .agg(F.collect_set(F.struct((-F.length("value")).alias("order"), "value")).alias("live"))
        .select("row", F.transform(F.array_sort("live"), lambda v: v["value"]).alias("live"))
    )
    masked = F.aggregate("live", F.col("text"), lambda t, v: F.replace(t, v, F.lit(MASK)))
    news = {text_column: masked, length_column: F.length(masked)}

    def value(column: str) -> Column:
        old = F.col(f"doc.`{column}`")
        if column not in news:
            return old.alias(column)
        new = news[column].cast(docs.schema[column].dataType)
        return F.when(F.col("live").isNull(), old).otherwise(new).alias(column)

    changed = hits.join(values, "row", "left").select(*map(value, docs.columns))
    return docs.where(~_has_candidate(text)).unionByName(changed)
