"""Settings of the mail classification jobs."""

from __future__ import annotations

from dataclasses import dataclass, replace

# Results depend on them, so they are stated as they are.
SEED = 42
TEST_SHARE = 0.2
FOLDS = 3
HAM, SPAM = 0, 1
DECISION_MARGIN = 0.12
PREVIEW_CHARS = 220

# Words of the keyword baseline.
KEYWORDS = (
    "free",
    "winner",
    "click",
    "urgent",
    "limited",
    "offer",
    "buy",
    "money",
    "credit",
    "viagra",
)

# The grids that are searched.
NB_ALPHAS = (0.1, 0.5, 1.0)
SVM_COSTS = (0.1, 1.0, 3.0, 10.0)
LR_COSTS = (0.1, 1.0, 10.0)
LR_SOLVERS = ("lbfgs", "liblinear")
LR_ITERATIONS = 1000
FOREST_TREES = (100, 200, 300)
FOREST_DEPTHS = (None, 10, 20)
FOREST_MIN_SPLIT = (2, 5)
FOREST_FEATURES = ("sqrt", "log2")
BOOST_ROUNDS = (100, 200)
BOOST_DEPTHS = (3, 6)
BOOST_RATES = (0.1, 0.3)
BOOST_ROW_SHARES = (0.8, 1.0)
BOOST_FEATURE_SHARES = (0.8, 1.0)

# Names that reports show, and their columns.
MODEL_LABELS = {
    "majority": "Majority Baseline",
    "keyword": "Keyword Baseline",
    "nb": "Naive Bayes",
    "svm": "Linear SVM",
    "rf": "Random Forest",
    "lr": "Logistic Regression",
    "xgb": "XGBoost",
}

METRIC_NAMES = (
    "precision_ham",
    "recall_ham",
    "f1_ham",
    "support_ham",
    "precision_spam",
    "recall_spam",
    "f1_spam",
    "support_spam",
    "macro_f1",
    "weighted_f1",
    "balanced_accuracy",
    "specificity",
    "npv",
    "false_positive_rate",
    "false_negative_rate",
    "roc_auc",
    "accuracy",
    "tn",
    "fp",
    "fn",
    "tp",
)

LEADERBOARD_HEAD = (
    "model",
    "precision_spam",
    "recall_spam",
    "f1_spam",
    "accuracy",
    "tn",
    "fp",
    "fn",
    "tp",
    "cv_best_f1",
    "best_params",
)

# English stop words of pyspark.ml.feature.StopWordsRemover (a test compares them).
ENGLISH_STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he
    him his himself she her hers herself it its itself they them their theirs
    themselves what which who whom this that these those am is are was were be
    been being have has had having do does did doing a an the and but if or
    because as until while of at by for with about against between into through
    during before after above below to from up down in out on off over under
    again further then once here there when where why how all any both each few
    more most other some such no nor not only own same so than too very s t can
    will just don should now i'll you'll he'll she'll we'll they'll i'd you'd
    he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've
    you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't
    doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot
    could here's how's let's ought that's there's what's when's where's who's
    why's would
    """.split()
)


@dataclass(frozen=True)
class FeatureConfig:
    """How a cleaned mail becomes weighted terms."""

    name: str = "word_1_2"
    analyzer: str = "word"
    min_n: int = 1
    max_n: int = 2
    min_df: int = 2
    max_df: float = 0.95
    sublinear_tf: bool = True
    l2_norm: bool = True
    stop_words: tuple[str, ...] = ENGLISH_STOP_WORDS

    def __post_init__(self) -> None:
        if self.analyzer not in ("word", "char_wb"):
            raise ValueError(f"unknown analyzer: {self.analyzer}")
        if not 1 <= self.min_n <= self.max_n:
            raise ValueError("n-gram range must satisfy 1 <= min_n <= max_n")

    def with_changes(self, **changes) -> "FeatureConfig":
        return replace(self, **changes)


WORD_1_2 = FeatureConfig()
CHAR_3_5 = FeatureConfig(
    name="char_3_5", analyzer="char_wb", min_n=3, max_n=5, min_df=3, stop_words=()
)
EXPERIMENTS = (WORD_1_2, CHAR_3_5)
