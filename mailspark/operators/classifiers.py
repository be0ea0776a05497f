"""Parameter grids of the classifiers, and what a point of a grid stands for.

A grid is a list of dictionaries, whose keys are those that saved ``best_params`` show.
``linear_point`` maps one to a fit of ``operators.linear``; those of tree models say how
``operators.forest`` and ``operators.boosting`` grow.
"""

from __future__ import annotations

import math
from itertools import product

from mailspark.config import (
    BOOST_DEPTHS,
    BOOST_FEATURE_SHARES,
    BOOST_RATES,
    BOOST_ROUNDS,
    BOOST_ROW_SHARES,
    FOREST_DEPTHS,
    FOREST_FEATURES,
    FOREST_MIN_SPLIT,
    FOREST_TREES,
    LR_COSTS,
    LR_ITERATIONS,
    LR_SOLVERS,
    SVM_COSTS,
)
from mailspark.operators import boosting
from mailspark.operators.forest import NO_LIMIT, Cut
from mailspark.operators.linear import LOGISTIC, SQUARED_HINGE, Point

#: The scale at which the penalty on an intercept no longer shows in a fit.
FREE_INTERCEPT = 100.0


def grid_of(**axes) -> list[dict]:
    return [dict(zip(axes, values)) for values in product(*axes.values())]


GRIDS = {
    "svm": grid_of(clf__C=SVM_COSTS),
    "lr": grid_of(clf__C=LR_COSTS, clf__max_iter=(LR_ITERATIONS,), clf__solver=LR_SOLVERS),
    "rf": grid_of(
        clf__n_estimators=FOREST_TREES,
        clf__max_depth=FOREST_DEPTHS,
        clf__min_samples_split=FOREST_MIN_SPLIT,
        clf__max_features=FOREST_FEATURES,
    ),
    "xgb": grid_of(
        clf__n_estimators=BOOST_ROUNDS,
        clf__max_depth=BOOST_DEPTHS,
        clf__learning_rate=BOOST_RATES,
        clf__subsample=BOOST_ROW_SHARES,
        clf__colsample_bytree=BOOST_FEATURE_SHARES,
    ),
}
LINEAR = ("svm", "lr")
TREES = ("rf", "xgb")


def linear_point(name: str, params: dict) -> Point:
    """The fit a grid point stands for; one solver of logistic regression penalises the
    intercept like any weight, the other leaves it free."""
    if name == "svm":
        return Point(SQUARED_HINGE, params["clf__C"])
    if name == "lr":
        penalised = params.get("clf__solver") == "liblinear"
        return Point(LOGISTIC, params["clf__C"], 1.0 if penalised else FREE_INTERCEPT)
    raise ValueError(f"no linear model: {name}")


def drawn_share(max_features: str, terms: int) -> float:
    """The share of the terms that a node of a forest draws."""
    if terms <= 1:
        return 1.0
    wanted = {"sqrt": math.sqrt, "log2": math.log2}[max_features](terms)
    return min(1.0, max(1.0, math.floor(wanted)) / terms)


def forest_cut(params: dict) -> Cut:
    depth = params["clf__max_depth"]
    return Cut(NO_LIMIT if depth is None else depth, params["clf__min_samples_split"])


def boosting_run(params: dict, view: str, fold: int | None) -> boosting.Run:
    return boosting.Run(
        view,
        fold,
        params["clf__max_depth"],
        params["clf__learning_rate"],
        params["clf__subsample"],
        params["clf__colsample_bytree"],
    )
