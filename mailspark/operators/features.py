"""TF-IDF as long tables.

Term documents hold one row per mail with its counted terms; ``term_counts``
unfolds them into ``(mail, token, tf)`` rows.  Document frequencies, weights and
every model that is linear in the weights are joins and aggregates over those
rows, so neither vocabulary nor matrix has to fit anywhere as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailspark.config import FeatureConfig
from mailspark.functions.terms import count_terms, term_documents
from mailspark.sources.scratch import written


def prepared_terms(mails: DataFrame, config: FeatureConfig) -> DataFrame:
    """Mails with counted terms in place of text, as a written table.

    The text work is done once, row by row, without any shuffle.
    """
    return written(count_terms(term_documents(mails, config)), "terms")


def term_counts(docs: DataFrame) -> DataFrame:
    """``(…, token, tf)`` rows of mails with counted terms."""
    keys = [c for c in docs.columns if c != "terms"]
    # The outer form keeps Spark from deriving a filter on the unfolded array,
    # which would repeat the text work that made it.
    return (
        docs.select(*keys, F.explode_outer("terms").alias("_term"))
        .where(F.col("_term").isNotNull())
        .select(*keys, "_term.token", "_term.tf")
    )


def scaled_tf(config: FeatureConfig, tf: Column | None = None) -> Column:
    tf = F.col("tf") if tf is None else tf
    return F.lit(1.0) + F.log(tf) if config.sublinear_tf else tf.cast("double")


def smooth_idf(df, n, log=F.log):
    """Of columns, or of arrays with their ``log``."""
    return log((n + 1) / (df + 1)) + 1.0


def kept_df(df, n, config: FeatureConfig):
    """Of columns or arrays."""
    return (df >= config.min_df) & (df <= n * config.max_df)


def document_frequencies(docs: DataFrame) -> DataFrame:
    """``token, df`` over all given mails."""
    return term_counts(docs.select("terms")).groupBy("token").agg(F.count("*").alias("df"))


def vocabulary(docs: DataFrame, config: FeatureConfig) -> DataFrame:
    """``token, df, idf`` of the terms kept by the document-frequency limits."""
    n = docs.select(F.count("*").alias("n")).scalar()
    return (
        document_frequencies(docs)
        .withColumn("n", n)
        .where(kept_df(F.col("df"), F.col("n"), config))
        .select("token", "df", smooth_idf(F.col("df"), F.col("n")).alias("idf"))
    )


def tfidf(
    docs: DataFrame, vocab: DataFrame, config: FeatureConfig, carry: tuple[str, ...] = ()
) -> DataFrame:
    """``(id, token, tf, weight)``; terms outside the vocabulary are dropped first.

    ``carry`` names further columns of ``vocab`` to keep.
    """
    weighted = (
        term_counts(docs)
        .join(vocab.select("token", "idf", *carry), "token")
        .withColumn("weight", scaled_tf(config) * F.col("idf"))
    )
    if config.l2_norm:
        norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy("id")))
        weighted = weighted.withColumn("weight", F.col("weight") / norm)
    return weighted.drop("idf")


def linear_sums(
    docs: DataFrame,
    table: DataFrame,
    idf: Column,
    weights: dict[str, Column],
    config: FeatureConfig,
) -> DataFrame:
    """``docs`` (without terms) plus, per name, the dot product of the mail's
    vector with that weight column of ``table``.

    The mail's length is summed beside the products and divided out at the end,
    so one join and one combined aggregate do all the work.  The other columns of
    a mail go through the aggregate with it, so ``docs`` is read once; ids must be
    unique, and a long text is better left out.  A mail without any known term
    gets 0.
    """
    products = {name: f"_sum_{i}" for i, name in enumerate(weights)}
    length = F.sum(F.col("_w") * F.col("_w"))
    kept = [c for c in docs.columns if c != "terms"]
    rest = [c for c in kept if c != "id"]
    norm = F.sqrt("_length") if config.l2_norm else F.lit(1.0)
    return (
        docs.select(*kept, F.explode_outer("terms").alias("_term"))
        .select(*kept, "_term.token", "_term.tf")
        .join(table, "token", "left")
        .withColumn("_w", scaled_tf(config) * idf)
        .groupBy("id")
        .agg(
            *[F.any_value(c).alias(c) for c in rest],
            length.alias("_length"),
            *[F.sum(F.col("_w") * weights[n]).alias(products[n]) for n in weights],
        )
        .select(
            *kept,
            *[F.coalesce(F.col(products[n]) / norm, F.lit(0.0)).alias(n) for n in weights],
        )
    )


def idf_extremes(vocab: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` commonest and ``k`` rarest terms by idf."""
    ranked = []
    for end, order in (("lowest", F.asc("idf")), ("highest", F.desc("idf"))):
        top = vocab.select("token", "idf").orderBy(order, "token").limit(k)
        place = F.row_number().over(Window.orderBy(order, "token"))  # k rows
        ranked.append(top.select(F.lit(end).alias("end"), place.alias("place"), "token", "idf"))
    return ranked[0].unionByName(ranked[1])


def matrix_stats(docs: DataFrame, vocab: DataFrame) -> DataFrame:
    """Mails, vocabulary size, non-zero cells and their share.

    A term fills one cell per mail that holds it, so the cells are the sum of df.
    """
    terms = vocab.agg(
        F.count("*").alias("vocabulary"), F.coalesce(F.sum("df"), F.lit(0)).alias("nnz")
    )
    n = docs.select(F.count("*").alias("n")).scalar()
    return terms.withColumn("docs", n).select(
        "docs",
        "vocabulary",
        "nnz",
        F.try_divide(F.col("nnz").cast("double"), F.col("docs") * F.col("vocabulary")).alias(
            "density"
        ),
    )
