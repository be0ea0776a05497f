"""Training: grid search per model, leaderboard, best model."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailspark.config import EXPERIMENTS, FOLDS, NB_ALPHAS, SPAM, WORD_1_2, FeatureConfig
from mailspark.operators import boosting, forest, linear, naive_bayes
from mailspark.operators.baselines import keyword_predictions, majority_predictions
from mailspark.operators.blocks import Blocks, mail_blocks, term_blocks
from mailspark.operators.classifiers import (
    GRIDS,
    LINEAR,
    boosting_run,
    drawn_share,
    forest_cut,
    linear_point,
)
from mailspark.operators.leaderboard import best_model, leaderboard
from mailspark.operators.metrics import f1_score, metric_rows
from mailspark.operators.split import part_ends, with_parts
from mailspark.operators.trees import NODE_COLUMNS, binned_vectors
from mailspark.plans.ledger import Ledger
from mailspark.plans.model import MailModel, save_model
from mailspark.sources.reports import save_table
from mailspark.sources.scratch import DENSE, written

MODEL_ORDER = ("majority", "keyword", "nb", "svm", "rf", "lr", "xgb")


def part_blocks(parts: DataFrame, config: FeatureConfig) -> Blocks:
    """Mails with ``split`` and ``fold`` as blocks of terms."""
    return mail_blocks(parts, config)


class TermTables:
    """The counted terms of some mails in blocks, written once for each feature configuration."""

    def __init__(self, mails: DataFrame):
        self.mails = mails
        self.coded: dict[FeatureConfig, Blocks] = {}

    def blocks(self, config: FeatureConfig) -> Blocks:
        if config not in self.coded:
            self.coded[config] = part_blocks(self.mails, config)
        return self.coded[config]


def split_mails(mails: DataFrame) -> DataFrame:
    """Mails with ``split`` and ``fold``.

    The mails are written once.  The ends of the parts (one row per label) are
    found on two narrow columns, and the parts then follow from a projection.
    """
    base = written(mails, "mails", compression=DENSE)
    return with_parts(base, written(part_ends(base), "part-ends"))


@dataclass(frozen=True)
class TrainVectors:
    """Binned vectors of train mails in some views, and their vocabulary."""

    vectors: DataFrame
    vocab: DataFrame
    terms: dict[str, int]


def binned_train(docs: DataFrame | Blocks, config: FeatureConfig, folds: int | None) -> TrainVectors:
    """The vectors that trees grow on; those of the views without a fold if there are folds,
    else of all train mails."""
    train = term_blocks(docs).train()
    sizes = linear.view_sizes(train, folds)
    views = [v for v in sizes if (v == naive_bayes.FINAL) != bool(folds)]
    vocab = linear.view_vocabulary(train, config, sizes, folds)
    terms = vocab.agg(*[F.count(f"{v}_idf").alias(v) for v in views]).first().asDict()
    vectors = written(binned_vectors(train, vocab, views, config), "binned-vectors")
    return TrainVectors(vectors, vocab, terms)


def _search_forest(
    docs: DataFrame | Blocks, config: FeatureConfig, grid: Sequence[dict], folds: int
) -> tuple[dict, float]:
    """The grid point with the best mean F1 over the folds, all from one growth."""
    data = binned_train(docs, config, folds)
    features = list(dict.fromkeys(point["clf__max_features"] for point in grid))
    cuts = tuple(dict.fromkeys(forest_cut(point) for point in grid))
    sizes = tuple(sorted({point["clf__n_estimators"] for point in grid}))
    runs = tuple(
        forest.Run(f"cv{k}", k, drawn_share(m, data.terms[f"cv{k}"]))
        for m in features
        for k in range(folds)
    )
    growth = forest.Growth(
        runs, max(sizes), max(c.depth for c in cuts), min(c.least for c in cuts), cuts, sizes
    )
    is_spam, found = F.col("label") == SPAM, F.round("vote", naive_bayes.SCORE_DIGITS) > 0.5
    counts = forest.grow(data.vectors, growth).votes.groupBy("run", "cut", "trees").agg(
        F.count_if(is_spam & found).alias("tp"),
        F.count_if(~is_spam & found).alias("fp"),
        F.count_if(is_spam & ~found).alias("fn"),
    )
    f1 = counts.select("run", "cut", "trees", f1_score("tp", "fp", "fn").alias("f1"))
    scores = {(r["run"], r["cut"], r["trees"]): r["f1"] for r in f1.collect()}  # one per point and fold

    def mean(point: dict) -> float:
        first, cut = features.index(point["clf__max_features"]) * folds, cuts.index(forest_cut(point))
        of_folds = [scores[first + k, cut, point["clf__n_estimators"]] for k in range(folds)]
        return round(sum(of_folds) / folds, naive_bayes.SCORE_DIGITS)

    return _best(grid, [mean(point) for point in grid])


def _search_boosting(
    docs: DataFrame | Blocks, config: FeatureConfig, grid: Sequence[dict], folds: int
) -> tuple[dict, float]:
    """The grid point with the best mean F1 over the folds; all points advance together."""
    data = binned_train(docs, config, folds)
    runs = tuple(
        dict.fromkeys(boosting_run(point, f"cv{k}", k) for point in grid for k in range(folds))
    )
    rounds = sorted({point["clf__n_estimators"] for point in grid})
    boosted = boosting.boost(data.vectors, runs, rounds[-1], rounds)
    means = {n: boosting.mean_f1(boosted, runs, n) for n in rounds}
    scores = [
        round(means[p["clf__n_estimators"]][boosting_run(p, "", None)], naive_bayes.SCORE_DIGITS)
        for p in grid
    ]
    return _best(grid, scores)


def _best(grid: Sequence[dict], scores: list[float]) -> tuple[dict, float]:
    """The point with the highest score (first wins ties), and that score."""
    best = max(range(len(grid)), key=lambda i: scores[i])
    return grid[best], scores[best]


SEARCHES = {"rf": _search_forest, "xgb": _search_boosting}


def _fit_trees(
    name: str, docs: Blocks, config: FeatureConfig, params: dict, cv_f1: float | None
) -> MailModel:
    """Trees at one grid point on all train mails."""
    data = binned_train(docs, config, None)
    view, rounds = naive_bayes.FINAL, params["clf__n_estimators"]
    losses = None
    if name == "rf":
        cut = forest_cut(params)
        share = drawn_share(params["clf__max_features"], data.terms[view])
        growth = forest.Growth((forest.Run(view, None, share),), rounds, cut.depth, cut.least)
        nodes = forest.grow(data.vectors, growth).nodes
    else:
        run = boosting_run(params, view, None)
        boosted = boosting.boost(data.vectors, (run,), rounds)
        losses = tuple(boosted.losses[0])
        nodes = data.vectors.sparkSession.createDataFrame(
            boosted.tree_rows(0, rounds),
            "tree int, node long, term long, edge int, absent_right boolean, value double",
        )
    vocab = data.vocab.where(F.col(f"{view}_idf").isNotNull())
    return MailModel(
        name,
        config,
        params,
        cv_f1,
        written(vocab.select("token", "index", F.col(f"{view}_idf").alias("idf")), "tree-terms"),
        terms=data.terms[view],
        trees=written(nodes.select(*NODE_COLUMNS), "trees"),
        losses=losses,
    )


def _train_linear(
    name: str, docs: DataFrame | Blocks, config: FeatureConfig, grid: Sequence[dict], folds: int | None
) -> MailModel:
    """The best of a grid, all of whose points are fitted together on all views.

    Without ``folds`` nothing is compared, and the first point is taken.
    """
    found = linear.search(docs, config, [linear_point(name, point) for point in grid], folds)
    best, cv_f1 = 0, None
    if folds:
        means = found.fold_f1(term_blocks(docs).train())
        best = max(range(len(grid)), key=lambda i: means[i])
        cv_f1 = means[best]
    return MailModel(
        name,
        config,
        grid[best],
        cv_f1,
        written(found.model_table(best), "linear-model"),
        found.intercepts[naive_bayes.FINAL, best],
        found.terms,
        gap=max(found.gaps.values()),
    )


def _train_naive_bayes(
    blocks: Blocks, config: FeatureConfig, grid: Sequence[dict], folds: int
) -> MailModel:
    alphas = tuple(point["clf__alpha"] for point in grid)
    fitted = naive_bayes.fit(blocks, config, alphas, folds)
    scored = naive_bayes.score(fitted, fitted.blocks.where(F.col("fold").isNotNull()))
    alpha, cv_f1 = naive_bayes.best_alpha(
        naive_bayes.grid_scores(naive_bayes.fold_scores(scored)), alphas
    )
    return naive_bayes_model(fitted, alpha, cv_f1)


def naive_bayes_model(
    fitted: naive_bayes.NaiveBayes, alpha: float, cv_f1: float | None = None
) -> MailModel:
    return MailModel(
        "nb",
        fitted.config,
        {"clf__alpha": alpha},
        cv_f1,
        fitted.model_table(alpha),
        fitted.prior_odds(naive_bayes.FINAL),
        int(fitted.totals[f"{naive_bayes.FINAL}_terms"]),
        blocks=fitted.blocks,
        numbered=fitted.numbered_table(alpha),
    )


def train_model(
    name: str,
    parts: DataFrame,
    configs: Sequence[FeatureConfig] | None = None,
    grid: Sequence[dict] | None = None,
    folds: int = FOLDS,
    terms: TermTables | None = None,
    ledger: Ledger | None = None,
) -> MailModel:
    """Grid-search one model on mails with ``split`` and ``fold``, refit on all train mails.

    The linear SVM also picks the feature configuration with the strictly best
    cross-validated F1, and names it among its parameters.  ``terms`` are the mails'
    term tables, where several models share them.  What ``ledger`` has is not done again.
    """
    if name == "nb":
        grid = grid or [{"clf__alpha": a} for a in NB_ALPHAS]
    elif name in GRIDS:
        grid = grid or GRIDS[name]
    else:
        raise ValueError(f"unknown model name: {name}")
    configs = configs or (EXPERIMENTS if name == "svm" else (WORD_1_2,))
    terms = terms or TermTables(parts.where(F.col("split") == "train"))
    best = None
    for config in configs:
        found = _trained(name, parts, config, grid, folds, terms, ledger)
        if best is None or found.cv_f1 > best.cv_f1:
            best = found
    if isinstance(best, _Searched):
        return _refitted(name, best, terms, ledger)
    if name == "svm":
        return replace(best, params={"experiment": best.config.name, **best.params})
    return best


@dataclass(frozen=True)
class _Searched:
    """What a search found before the refit on all train mails."""

    config: FeatureConfig
    params: dict
    cv_f1: float


def _trained(
    name: str, parts: DataFrame, config: FeatureConfig, grid: Sequence[dict], folds: int,
    terms: TermTables, ledger: Ledger | None,
) -> MailModel | _Searched:
    """The model of one configuration, or for trees the point that a search found."""
    spark = parts.sparkSession
    key = ledger.key(name, config, grid, folds) if ledger else None
    if name in SEARCHES:
        found = ledger.search(spark, key) if ledger else None
        if found is None:
            found = SEARCHES[name](terms.blocks(config), config, grid, folds)
            if ledger:
                ledger.put_search(spark, key, *found)
        return _Searched(config, *found)
    model = ledger.model(spark, key) if ledger else None
    if model is None:
        if name == "nb":
            model = _train_naive_bayes(terms.blocks(config), config, grid, folds)
        else:
            model = _train_linear(name, terms.blocks(config), config, grid, folds)
        if ledger:
            ledger.put_model(spark, key, model)
    return model


def _refitted(name: str, found: _Searched, terms: TermTables, ledger: Ledger | None) -> MailModel:
    spark = terms.mails.sparkSession
    key = ledger.key(name, found.config, [found.params], None) if ledger else None
    model = ledger.model(spark, key) if ledger else None
    if model is None:
        model = _fit_trees(name, terms.blocks(found.config), found.config, found.params, found.cv_f1)
        if ledger:
            ledger.put_model(spark, key, model)
    return replace(model, cv_f1=found.cv_f1)


def fit_model(
    name: str,
    parts: DataFrame,
    params: dict,
    config: FeatureConfig = WORD_1_2,
    terms: TermTables | None = None,
) -> MailModel:
    """Fit one model on all train mails at given parameters, without a search."""
    terms = terms or TermTables(parts.where(F.col("split") == "train"))
    docs = terms.blocks(config)
    if name in LINEAR:
        return _train_linear(name, docs, config, [params], None)
    return _fit_trees(name, docs, config, params, None)


def with_summary(
    rows: DataFrame, name: str, cv_f1: float | None = None, best_params: str | None = None
) -> DataFrame:
    return rows.withColumn("cv_best_f1", F.lit(cv_f1).cast("double")).withColumn(
        "best_params", F.lit(best_params).cast("string")
    ).withColumn("model_order", F.lit(MODEL_ORDER.index(name)))


def score_test(model: MailModel, test: DataFrame, terms: TermTables | None = None) -> DataFrame:
    """Test mails, or those of ``terms``, under a model; written."""
    if terms is None:
        scored = model.score(test.select("id", "label", "text"), keep_text=False)
    else:
        blocks = terms.blocks(model.config)
        if model.blocks is not None and model.blocks.mails is blocks.mails:
            blocks = model.blocks  # with the known terms alone, by number
        scored = model.score_blocks(blocks.where(F.col("fold").isNull()))
        scored = scored.select("id", "label", "score", "prediction")
    return written(scored.withColumn("model", F.lit(model.name)), "scored")


def row_of_scores(model: MailModel, scored: DataFrame) -> DataFrame:
    """Unrounded metric row of a model from its scored test mails."""
    return with_summary(metric_rows(scored), model.name, model.cv_f1, model.best_params)


def model_row(model: MailModel, test: DataFrame, terms: TermTables | None = None) -> DataFrame:
    """Unrounded metric row of a model on test mails, or on those of ``terms``."""
    return row_of_scores(model, score_test(model, test, terms))


def baseline_rows(parts: DataFrame) -> DataFrame:
    """Unrounded metric rows of the majority and keyword baselines."""
    train = parts.where(F.col("split") == "train")
    test = parts.where(F.col("split") == "test")
    majority = majority_predictions(train.select("label"), test.select("label"))
    keyword = keyword_predictions(test.select("label", "text")).select("label", "prediction")
    rows = [
        with_summary(metric_rows(scored.withColumn("model", F.lit(name))), name)
        for name, scored in (("majority", majority), ("keyword", keyword))
    ]
    return rows[0].unionByName(rows[1])


def train_all(
    parts: DataFrame,
    names: Iterable[str] = ("nb", "svm", "rf", "lr", "xgb"),
    out: str | None = None,
    grids: dict[str, Sequence[dict]] | None = None,
    configs: dict[str, Sequence[FeatureConfig]] | None = None,
    ledger: str | None = None,
) -> tuple[DataFrame, dict[str, MailModel], str | None]:
    """Train and rank; with ``out``, save splits, models, the best model and the board.

    With ``ledger``, a folder, what an earlier run of the same mails finished is taken up.

    Returns the leaderboard, the models and the name of the best one.
    """
    test = parts.where(F.col("split") == "test")
    rows = baseline_rows(parts)
    models, terms = {}, TermTables(parts)
    done = Ledger.of(ledger, parts) if ledger else None
    for name in names:
        models[name] = train_model(
            name, parts, (configs or {}).get(name), (grids or {}).get(name), terms=terms, ledger=done
        )
        rows = rows.unionByName(model_row(models[name], test, terms))
    rows = written(rows, "metric-rows")
    board = leaderboard(rows)
    first = best_model(rows).first()
    best = first["model"] if first else None
    if out is not None:
        save_table(parts.drop("split", "fold"), f"{out}/emails_raw")
        for split in ("train", "test"):
            save_table(parts.where(F.col("split") == split).drop("split", "fold"), f"{out}/{split}")
        save_table(board.coalesce(1), f"{out}/metrics", "csv")
        for name, model in models.items():
            save_model(model, f"{out}/models/{name}_best")
        if best is not None:
            save_model(models[best], f"{out}/models/best_model")
    return board, models, best


def run_experiments(
    parts: DataFrame,
    names: Sequence[str] = ("nb", "svm"),
    configs: Sequence[FeatureConfig] = EXPERIMENTS,
    grids: dict[str, Sequence[dict]] | None = None,
    ledger: str | None = None,
) -> DataFrame:
    """One metric row per feature configuration and model; ``ledger`` as for ``train_all``."""
    test, terms = parts.where(F.col("split") == "test"), TermTables(parts)
    done = Ledger.of(ledger, parts) if ledger else None
    rows = None
    for config in configs:
        for name in names:
            model = train_model(name, parts, (config,), (grids or {}).get(name), terms=terms, ledger=done)
            row = model_row(model, test, terms).withColumn("experiment", F.lit(config.name))
            rows = row if rows is None else rows.unionByName(row)
    return rows.drop("model_order")
