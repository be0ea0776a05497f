"""A fitted model as tables, and its saved form."""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailspark.config import HAM, SPAM, FeatureConfig
from mailspark.functions.clean import clean_text
from mailspark.functions.terms import add_terms, count_terms
from mailspark.operators.blocks import Blocks, block_sums
from mailspark.operators.classifiers import TREES
from mailspark.operators.features import linear_sums
from mailspark.operators.naive_bayes import SCORE_DIGITS, spam_probability
from mailspark.operators.trees import tree_sums
from mailspark.sources.publish import children_of, delete, exists, publish_text, published_text

PROBABILITY, DECISION = "probability", "decision"


@dataclass(frozen=True)
class MailModel:
    """``table`` has token and idf, with ``weight`` for a linear model or ``index``
    for a tree model (whose nodes are in ``trees``).  ``gap`` is the largest relative
    duality gap of the fits that a linear model was chosen from, ``losses`` are the mean
    losses of boosted trees before each round and after the last.  ``blocks`` are those that
    Naive Bayes was fitted on, ``numbered`` is its table with their numbers of terms; neither
    is saved."""

    name: str
    config: FeatureConfig
    params: dict
    cv_f1: float | None
    table: DataFrame
    intercept: float = 0.0
    terms: int = 0
    gap: float | None = None
    losses: tuple[float, ...] | None = None
    trees: DataFrame | None = field(default=None, compare=False)
    blocks: Blocks | None = field(default=None, compare=False)
    numbered: DataFrame | None = field(default=None, compare=False)

    @property
    def score_type(self) -> str:
        return DECISION if self.name == "svm" else PROBABILITY

    @property
    def best_params(self) -> str:
        return json.dumps(self.params)

    def weights(self) -> DataFrame:
        """Token weights of a linear model."""
        if self.trees is not None:
            raise ValueError(f"{self.name} has no token weights")
        return self.table.select("token", "idf", "weight")

    def score_terms(self, docs: DataFrame) -> DataFrame:
        """Term documents with ``score`` and ``prediction`` added."""
        if self.trees is not None:
            return self._score_by_trees(docs)
        margin = {"_dot": F.col("weight")}
        return self._score_sums(linear_sums(docs, self.table, F.col("idf"), margin, self.config))

    def score_blocks(self, blocks: Blocks) -> DataFrame:
        """The mails of blocks with ``score`` and ``prediction`` added."""
        if self.trees is not None:
            return self._score_by_trees(blocks)
        margin = {"_dot": F.col("weight")}
        table = self.weights() if self.numbered is None else self.numbered
        return self._score_sums(block_sums(blocks, table, F.col("idf"), margin, self.config))

    def _score_sums(self, sums: DataFrame) -> DataFrame:
        sums = sums.withColumn(
            "_margin", F.round(F.col("_dot") + F.lit(self.intercept), SCORE_DIGITS)
        )
        score = F.col("_margin")
        if self.score_type == PROBABILITY:
            score = spam_probability(score)
        return (
            sums.withColumn("score", score)
            .withColumn("prediction", F.when(F.col("_margin") > 0, SPAM).otherwise(HAM))
            .drop("_dot", "_margin")
        )

    def _score_by_trees(self, docs: DataFrame | Blocks) -> DataFrame:
        """A forest's mean vote, or the probability of boosted trees' summed margin."""
        sums = tree_sums(docs, self.table, self.trees, self.config)
        total = F.round("tree_sum", SCORE_DIGITS)
        if self.name == "rf":
            score = F.round(total / self.params["clf__n_estimators"], SCORE_DIGITS)
            is_spam = score > 0.5
        else:
            score, is_spam = spam_probability(total), total > 0
        return (
            sums.withColumn("score", score)
            .withColumn("prediction", F.when(is_spam, SPAM).otherwise(HAM))
            .drop("tree_sum")
        )

    def score(self, mails: DataFrame, keep_text: bool = True) -> DataFrame:
        """Mails (id, text, …) with ``score`` and ``prediction`` added; ids are unique.

        Without ``keep_text`` the mails are read once and no text is moved.
        """
        docs = add_terms(clean_text(mails), self.config).drop("clean", "text")
        scored = self.score_terms(count_terms(docs))
        if not keep_text:
            return scored
        news = [c for c in scored.columns if c not in mails.columns]
        return mails.join(scored.select("id", *news), "id")


POINTER, KEPT_VERSIONS = "CURRENT", 2


def save_model(model: MailModel, path: str) -> str:
    """Save a new version of a model and make it the current one; returns its name.

    A version is a folder of its own: tables as parquet, settings as one line of JSON.
    When it is complete, the file that names the current version is replaced by a rename,
    so whoever loads the model meanwhile gets the old version or the new one as a whole.
    The ``KEPT_VERSIONS`` last versions stay for those who still read them.
    """
    spark = model.table.sparkSession
    name = f"{time.time_ns():020}-{uuid.uuid4().hex[:8]}"
    folder = f"{path}/versions/{name}"
    model.table.write.parquet(f"{folder}/table")
    if model.trees is not None:
        model.trees.write.parquet(f"{folder}/trees")
    settings = {
        "name": model.name,
        "config": asdict(model.config),
        "params": model.params,
        "cv_f1": model.cv_f1,
        "intercept": model.intercept,
        "terms": model.terms,
        "gap": model.gap,
        "losses": model.losses,
    }
    publish_text(spark, f"{folder}/settings", json.dumps(settings))
    publish_text(spark, f"{path}/{POINTER}", name)
    complete = [n for _, n in children_of(spark, f"{path}/versions") if exists(spark, f"{path}/versions/{n}/settings")]
    for old in sorted(complete)[:-KEPT_VERSIONS]:
        if old != name:
            delete(spark, f"{path}/versions/{old}")
    return name


def current_version(spark: SparkSession, path: str) -> str | None:
    return published_text(spark, f"{path}/{POINTER}")


def load_model(spark: SparkSession, path: str, version: str | None = None) -> MailModel:
    """The current version of a saved model, or the one named."""
    version = version or current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no model at {path}")
    folder = f"{path}/versions/{version}"
    settings = json.loads(published_text(spark, f"{folder}/settings"))
    config = settings.pop("config")
    config["stop_words"] = tuple(config["stop_words"])
    if settings.get("losses") is not None:
        settings["losses"] = tuple(settings["losses"])
    trees = spark.read.parquet(f"{folder}/trees") if settings["name"] in TREES else None
    return MailModel(
        config=FeatureConfig(**config),
        table=spark.read.parquet(f"{folder}/table"),
        trees=trees,
        **settings,
    )


class LatestModel:
    """Scores mails with the version of a saved model that is current when it is called."""

    def __init__(self, path: str):
        self.path, self.version, self.model = path, None, None

    def __call__(self, mails: DataFrame) -> DataFrame:
        spark = mails.sparkSession
        version = current_version(spark, self.path)
        if version != self.version or self.model is None:
            self.model, self.version = load_model(spark, self.path, version), version
        return self.model.score(mails, keep_text=False)
