"""Multinomial Naive Bayes by aggregation, with its whole grid search.

A *view* is a set of training mails: ``final`` is all of them, ``cv<k>`` leaves
fold k out.  One pass gives the document frequencies of all views, a second one
their class sums; every smoothing value is then a column expression.  Nothing is
refitted per fold or per value.  Mails are worked on in blocks, so shuffles hold a
term once per block.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailspark.config import HAM, NB_ALPHAS, SPAM, FeatureConfig
from mailspark.operators.blocks import TERM, Blocks, block_sums, cells_of, term_blocks, unpacked
from mailspark.operators.features import kept_df, smooth_idf
from mailspark.operators.metrics import f1_score
from mailspark.sources.scratch import DENSE, written

SCORE_DIGITS = 12
FINAL = "final"


def check_folds(last_fold: int | None, folds: int | None) -> None:
    """The folds asked for must be those the mails were dealt to."""
    if folds is not None and last_fold is not None and last_fold + 1 != folds:
        raise ValueError(f"the mails have {last_fold + 1} folds, not {folds}")


def view_members(folds: int | None) -> dict[str, Column]:
    """Which mails train each view; ``fold`` is null for mails that train nothing."""
    in_train = F.col("fold").isNotNull()
    views = {FINAL: in_train}
    for k in range(folds or 0):
        views[f"cv{k}"] = in_train & (F.col("fold") != k)
    return views


@dataclass(frozen=True)
class NaiveBayes:
    """``table`` has, per token, each view's idf and its class sums of weights; ``blocks`` are
    those it was fitted on, with the terms that some view keeps."""

    config: FeatureConfig
    alphas: tuple[float, ...]
    folds: int | None
    table: DataFrame
    totals: dict[str, float]
    mails: dict[str, int]
    blocks: Blocks

    def prior(self, view: str, label: int) -> float:
        both = self.mails[f"{view}_{HAM}"] + self.mails[f"{view}_{SPAM}"]
        return math.log(self.mails[f"{view}_{label}"] / both)

    def log_prob(self, view: str, label: int, alpha: float) -> Column:
        base = self.totals[f"{view}_{label}"] + alpha * self.totals[f"{view}_terms"]
        return F.log((F.col(f"{view}_{label}") + alpha) / F.lit(base))

    def log_odds(self, view: str, alpha: float) -> Column:
        return self.log_prob(view, SPAM, alpha) - self.log_prob(view, HAM, alpha)

    def prior_odds(self, view: str) -> float:
        return self.prior(view, SPAM) - self.prior(view, HAM)

    def model_table(self, alpha: float) -> DataFrame:
        """``token, idf, log_prob_ham, log_prob_spam, weight`` of the final model."""
        return self.numbered_table(alpha).select("token", "idf", "log_prob_ham", "log_prob_spam", "weight")

    def numbered_table(self, alpha: float) -> DataFrame:
        """``model_table`` with the numbers that ``blocks`` have for the terms."""
        return self.table.where(F.col(f"{FINAL}_idf").isNotNull()).select(
            *[c for c in self.table.columns if c.startswith(TERM)],
            "token",
            F.col(f"{FINAL}_idf").alias("idf"),
            self.log_prob(FINAL, HAM, alpha).alias("log_prob_ham"),
            self.log_prob(FINAL, SPAM, alpha).alias("log_prob_spam"),
            self.log_odds(FINAL, alpha).alias("weight"),
        )


def fit(
    docs: DataFrame | Blocks,
    config: FeatureConfig,
    alphas: tuple[float, ...] = NB_ALPHAS,
    folds: int | None = None,
) -> NaiveBayes:
    """Fit on term documents (id, label, fold, terms) or blocks; ``folds`` adds the CV views."""
    members = view_members(folds)
    blocks = term_blocks(docs)
    train = blocks.where(F.col("fold").isNotNull())
    mails = train.mails.agg(
        F.max("fold").alias("last_fold"),
        *[
            F.count_if(member & (F.col("label") == label)).alias(f"{view}_{label}")
            for view, member in members.items()
            for label in (HAM, SPAM)
        ]
    ).first().asDict()
    check_folds(mails.pop("last_fold"), folds)
    for name, n in mails.items():
        if not n:
            raise ValueError(f"no training mails for view_label {name}")
    sizes = {v: mails[f"{v}_{HAM}"] + mails[f"{v}_{SPAM}"] for v in members}

    def idf_of(view: str) -> Column:
        df, n = F.col(f"{view}_df"), F.lit(sizes[view])
        return F.when(kept_df(df, n, config), smooth_idf(df, n))

    # A term's number is its share and its place there; only this fit knows it.
    number = f"{TERM}{uuid.uuid4().hex}"
    idfs = {f"{v}_idf": idf_of(v) for v in members}
    fold_type = blocks.shares.schema["fold"].dataType.simpleString()
    held = written(
        blocks.shares.groupBy("share").applyInArrow(
            term_counter(sizes, config, number),
            f"block long, fold {fold_type}, code int, token string, {number} long, first boolean, "
            + ", ".join(f"{v}_df long" for v in members),
        ),
        "block-vocabulary",
        compression=DENSE,
    )
    # Counts are shuffled, not idfs, and only those of the views that a block trains.
    known = held.where(F.col("fold").isNotNull()).select(
        "block", "code", number, *[F.when(m, F.col(f"{v}_df")).cast("int").alias(f"{v}_df") for v, m in members.items()]
    )
    names = [f"{v}_{c}" for v in members for c in (HAM, SPAM)]
    sums = (
        train.mails.select("block", "id", "label", "fold", "cells", "codes", "counts")
        .groupBy("block")
        .cogroup(known.groupBy("block"))
        .applyInArrow(
            class_summer(sizes, config, number),
            ", ".join([f"{number} long", *[f"{n} double" for n in names]]),
        )
    )
    terms = held.where("first").select(
        number, "token", *[idf.alias(name) for name, idf in idfs.items()]
    )
    summed = sums.groupBy(number).agg(*[F.sum(n).alias(n) for n in names])
    table = written(terms.join(summed, number), "naive-bayes", compression=DENSE)
    totals = table.agg(
        *[F.count(f"{v}_idf").alias(f"{v}_terms") for v in members],
        *[
            F.coalesce(F.sum(f"{v}_{c}"), F.lit(0.0)).alias(f"{v}_{c}")
            for v in members
            for c in (HAM, SPAM)
        ],
    ).first().asDict()
    return NaiveBayes(config, tuple(alphas), folds, table, totals, mails, Blocks(blocks.mails, held.drop("first")))


def term_counter(sizes: dict[str, int], config: FeatureConfig, number: str):
    """The rows of a share's terms that some view keeps, with the df of each view; the number
    of a term goes with each of its rows, the first of which is marked."""

    def work(shares: pa.Table) -> pa.Table:
        shares = shares.sort_by("block")
        found, codes, df = unpacked(shares)
        of_share = np.repeat(np.arange(len(shares)), shares.column("n_terms").to_numpy())
        folds = [None if f is None else f"cv{f}" for f in shares.column("fold").to_pylist()]
        coded = found.dictionary_encode()
        term, n_terms = coded.indices.to_numpy(), len(coded.dictionary)
        counts, kept = {}, np.zeros(n_terms, bool)
        for view, n in sizes.items():
            trains = np.array([f is not None and f != view for f in folds], bool)
            counts[view] = np.bincount(term, df * trains[of_share], n_terms).astype(np.int64)
            kept |= kept_df(counts[view], n, config)
        first = np.zeros(len(term), bool)
        first[np.unique(term, return_index=True)[1]] = True
        rows = np.flatnonzero(kept[term])
        term = term[rows]
        columns = {c: shares.column(c).combine_chunks().take(pa.array(of_share[rows])) for c in ("block", "fold")}
        columns |= {"code": pa.array(codes[rows]), "token": found.take(pa.array(rows))}
        columns |= {number: pa.array((shares.column("share")[0].as_py() << 32) + term.astype(np.int64)), "first": pa.array(first[rows])}
        return pa.table(columns | {f"{v}_df": pa.array(c[term]) for v, c in counts.items()})

    return work


def class_summer(sizes: dict[str, int], config: FeatureConfig, number: str):
    """The class sums of a block's terms in the views that its fold is in, given the mails of all."""

    def work(mails: pa.Table, terms: pa.Table) -> pa.Table:
        x = cells_of(mails, terms, config)
        fold = x.mails.column("fold")[0].as_py() if len(x.mails) else None
        label = x.mails.column("label").to_numpy(zero_copy_only=False)[x.mail]
        found = {number: terms.column(number)}
        for view, n in sizes.items():
            sums = np.zeros((2, len(terms)))
            if view != f"cv{fold}" and len(x.row):
                df = x.column(f"{view}_df")
                idf = np.where(kept_df(df, n, config), smooth_idf(df, n, np.log), np.nan)
                w = x.tf * idf[x.row]
                kept = np.flatnonzero(~np.isnan(w))
                w = np.nan_to_num(w)
                share = w[kept] / x.lengths(w, config)[x.group[kept]]
                for c in (HAM, SPAM):
                    sums[c] = np.bincount(x.row[kept], share * (label[kept] == c), len(terms))
            found |= {f"{view}_{c}": pa.array(sums[c]) for c in (HAM, SPAM)}
        return pa.table(found)

    return work


def _by_view(model: NaiveBayes, of_view) -> Column:
    """The value of the view that scores a mail: the one its fold is left out of,
    or the final one for mails outside training."""
    value = of_view(FINAL)
    for k in range(model.folds or 0):
        value = F.when(F.col("fold") == k, of_view(f"cv{k}")).otherwise(value)
    return value


def spam_probability(margin: Column) -> Column:
    return F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)), SCORE_DIGITS)


def score(model: NaiveBayes, docs: DataFrame | Blocks) -> DataFrame:
    """One row per mail and smoothing value: ``alpha, score, prediction``.

    ``model.blocks`` are scored without looking for their known terms again.

    Training mails are scored by the view that left them out (when folds were
    fitted), other mails by the final one.  Margins are rounded so that equal
    mails score equally in whatever order their terms were summed.
    """
    blocks = term_blocks(docs)
    names = {f"margin_{i}": a for i, a in enumerate(model.alphas)}
    weights = {
        name: _by_view(model, lambda view, a=alpha: model.log_odds(view, a))
        for name, alpha in names.items()
    }
    idf = _by_view(model, lambda view: F.col(f"{view}_idf"))
    sums = block_sums(blocks, model.table, idf, weights, model.config)
    prior = _by_view(model, lambda view: F.lit(model.prior_odds(view)))
    rows = F.array(
        *[
            F.struct(
                F.lit(alpha).alias("alpha"),
                F.round(F.col(name) + prior, SCORE_DIGITS).alias("margin"),
            )
            for name, alpha in names.items()
        ]
    )
    kept = blocks.kept
    return sums.select(*kept, F.inline(rows)).select(
        *kept,
        "alpha",
        spam_probability(F.col("margin")).alias("score"),
        F.when(F.col("margin") > 0, SPAM).otherwise(HAM).alias("prediction"),
    )


def fold_scores(scored: DataFrame) -> DataFrame:
    """F1 on spam per smoothing value and fold, from scored training mails."""
    label, prediction = F.col("label"), F.col("prediction")
    return (
        scored.where(F.col("fold").isNotNull())
        .groupBy("alpha", "fold")
        .agg(
            F.count_if((label == SPAM) & (prediction == SPAM)).alias("tp"),
            F.count_if((label == HAM) & (prediction == SPAM)).alias("fp"),
            F.count_if((label == SPAM) & (prediction == HAM)).alias("fn"),
        )
        .select("alpha", "fold", f1_score("tp", "fp", "fn").alias("f1_spam"))
    )


def grid_scores(folds: DataFrame) -> DataFrame:
    """Mean F1 over the folds per smoothing value, rounded so that equal means tie."""
    mean = F.round(F.avg("f1_spam"), SCORE_DIGITS)
    return folds.groupBy("alpha").agg(mean.alias("cv_f1"))


def best_alpha(grid: DataFrame, alphas: tuple[float, ...]) -> tuple[float, float]:
    """The smoothing value with the highest mean F1 (first given wins ties) and that mean."""
    means = {row["alpha"]: row["cv_f1"] for row in grid.collect()}  # one row per value
    best = max(alphas, key=lambda alpha: means[alpha])
    return best, means[best]
