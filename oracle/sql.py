"""DuckDB SQL that states, independently, what each registered query returns."""

from __future__ import annotations

from mailspark.config import ENGLISH_STOP_WORDS, KEYWORDS, MODEL_LABELS, NB_ALPHAS

WS = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sub(text: str, pattern: str, replacement: str) -> str:
    return f"regexp_replace({text}, {quoted(pattern)}, {quoted(replacement)}, 'g')"


# --- cleaning -------------------------------------------------------------

def newlines(t: str) -> str:
    return f"replace(replace({t}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"


def header_lines(t: str) -> str:
    return sub(t, r"(?im)^(from|to|subject|cc|bcc|date):.*$", " ")


def lower(t: str) -> str:
    return f"lower({t})"


def urls(t: str) -> str:
    return sub(t, rf"(https?://[^{WS}]+|www\.[^{WS}]+)", " urltoken ")


def addresses(t: str) -> str:
    return sub(t, r"\b[\p{L}\p{N}_.\-]+@[\p{L}\p{N}_.\-]+\.[\p{L}\p{N}_]+\b", " emailtoken ")


def money(t: str) -> str:
    return sub(t, rf"[$€£][{WS}]?\d+(?:[.,]\d+)?", " moneytoken ")


def numbers(t: str) -> str:
    return sub(t, r"\b\d+(?:[.,]\d+)?\b", " numtoken ")


def base64_runs(t: str) -> str:
    return sub(t, r"[A-Za-z0-9+/]{40,}={0,2}", " ")


def tags(t: str) -> str:
    return sub(t, r"<[^>]+>", " ")


def punctuation(t: str) -> str:
    for mark, pattern in (("!", "!{3,}"), ("$", r"\${3,}"), ("?", r"\?{3,}")):
        t = sub(t, pattern, mark * 3)
    return t


def spaces(t: str) -> str:
    return sub(t, rf"[{WS}]+", " ")


def stripped(t: str) -> str:
    return sub(t, rf"^[{WS}]+|[{WS}]+$", "")


def clean(t: str) -> str:
    for step in (
        newlines, header_lines, lower, urls, addresses, money, numbers,
        base64_runs, tags, punctuation, spaces,
    ):
        t = step(t)
    return f"trim({t})"


LITERALS = r"""
(VALUES (-1, 'From: a@b.c' || chr(13) || chr(10) || 'hi http://x.y/z $ 5,000.5 !!!!! 12.5 a1 1a a_1 <b>x</b>'),
        (-2, 'subject : re' || chr(13) || 'To: q' || chr(10) || 'z'),
        (-3, 'tiền 10%/tháng 100.000.000 đ'),
        (-4, repeat('A', 41) || '=='),
        (-5, 'x from: y'),
        (-6, '<a href="http://x.y">click</a> b > c')) AS v(id, text)
"""
TEXTS = f"""texts AS (
  SELECT 'documents' AS kind, doc_id AS id, text FROM documents
  UNION ALL SELECT 'pages', page_id, html FROM pages
  UNION ALL SELECT 'literals', id, text FROM {LITERALS})"""


def step_query(expression: str) -> str:
    return f"WITH {TEXTS} SELECT kind, id, {expression} AS text FROM texts"


# --- corpus ---------------------------------------------------------------

CORPUS = """corpus AS (
  SELECT sha1(CAST(d.doc_id AS VARCHAR)) AS id, CAST(l.toxic AS INTEGER) AS label,
         CASE WHEN l.toxic = 1 THEN 'spam' ELSE 'ham' END AS label_name,
         d.text, d.source || '/' || CAST(d.doc_id AS VARCHAR) AS path
  FROM documents d JOIN labels l USING (doc_id)
  WHERE d.text IS NOT NULL AND l.toxic IS NOT NULL)"""

DEDUP = """unique_mails AS (
  SELECT id, label, label_name, text, path FROM (
    SELECT *, row_number() OVER (PARTITION BY sha1(text) ORDER BY label, path, id) AS rn
    FROM corpus) WHERE rn = 1)"""

PARTS = """label_sizes AS (
  SELECT label, count(*) AS n, (SELECT count(*) FROM corpus) AS total FROM corpus GROUP BY label),
shares AS (
  SELECT *, total - CAST(ceil(total * CAST(0.2 AS DOUBLE)) AS BIGINT) AS train_total FROM label_sizes),
bases AS (
  SELECT *, (n * train_total) // total AS base, (n * train_total) % total AS remainder FROM shares),
dealt AS (
  SELECT *, base + CASE WHEN row_number() OVER (ORDER BY remainder DESC, label)
                             <= train_total - sum(base) OVER () THEN 1 ELSE 0 END AS train FROM bases),
sizes AS (
  SELECT label, n, n - train AS test, train,
         coalesce(sum(train) OVER (ORDER BY label ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first_pos
  FROM dealt),
fold_sizes AS (
  SELECT label, test,
         (SELECT count(*) FROM range(first_pos::BIGINT, (first_pos + train)::BIGINT) r(p) WHERE p % 3 = 0) AS f0,
         (SELECT count(*) FROM range(first_pos::BIGINT, (first_pos + train)::BIGINT) r(p) WHERE p % 3 = 1) AS f1
  FROM sizes),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || id)) AS place FROM corpus),
parts AS (
  SELECT r.*, CASE WHEN place <= test THEN 'test' ELSE 'train' END AS split,
         CASE WHEN place <= test THEN NULL WHEN place <= test + f0 THEN 0
              WHEN place <= test + f0 + f1 THEN 1 ELSE 2 END AS fold
  FROM ranked r JOIN fold_sizes USING (label))"""

# --- features -------------------------------------------------------------

STOP_LIST = "[" + ", ".join(quoted(w) for w in ENGLISH_STOP_WORDS) + "]"


def word_terms(source: str = "parts", name: str = "terms") -> str:
    """``name``: one row per mail with ``words`` (stop words out) and its terms."""
    return f"""{name}_clean AS (SELECT * EXCLUDE (text), {clean('text')} AS clean FROM {source}),
{name}_words AS (
  SELECT * EXCLUDE (clean),
         [w FOR w IN regexp_extract_all(clean, '[\\p{{L}}\\p{{N}}_]+') IF NOT list_contains({STOP_LIST}, w)] AS words
  FROM {name}_clean),
{name} AS (
  SELECT * EXCLUDE (words),
         list_concat(words, [words[i] || ' ' || words[i + 1] FOR i IN range(1, len(words))]) AS terms
  FROM {name}_words)"""


def char_terms(source: str = "parts", name: str = "terms") -> str:
    return f"""{name}_clean AS (SELECT * EXCLUDE (text), {clean('text')} AS clean FROM {source}),
{name} AS (
  SELECT * EXCLUDE (clean),
         flatten([
           list_concat(
             [substr(' ' || w || ' ', i, 3) FOR i IN range(1, length(w) + 1)],
             list_concat(
               [substr(' ' || w || ' ', i, 4) FOR i IN range(1, length(w))],
               [substr(' ' || w || ' ', i, 5) FOR i IN range(1, length(w) - 1)]))
           FOR w IN string_split(clean, ' ') IF w <> '']) AS terms
  FROM {name}_clean)"""


TF = """tf AS (
  SELECT id, label, split, fold, token, count(*) AS tf
  FROM (SELECT id, label, split, fold, unnest(terms) AS token FROM terms) GROUP BY ALL)"""


def vocab(min_df: int = 2) -> str:
    return f"""vocab AS (
  SELECT token, df, ln((n + 1) / (df + 1)) + 1 AS idf
  FROM (SELECT token, count(*)::DOUBLE AS df FROM tf WHERE split = 'train' GROUP BY token),
       (SELECT count(*)::DOUBLE AS n FROM parts WHERE split = 'train')
  WHERE df >= {min_df} AND df <= CAST(0.95 AS DOUBLE) * n)"""


def nb(alphas=NB_ALPHAS, min_df: int = 2, cv: bool = True) -> str:
    """CTEs up to ``scored``: every mail scored by the view that did not train on it."""
    views = "(VALUES ('final', -1)" + (
        ", ('cv0', 0), ('cv1', 1), ('cv2', 2)" if cv else ""
    ) + ") AS v(view, left_out)"
    scored_view = "CASE WHEN split = 'test' THEN 'final' ELSE 'cv' || fold END"
    alpha_rows = ", ".join(f"(CAST({a} AS DOUBLE))" for a in alphas)
    return f"""views AS (SELECT * FROM {views}),
alphas AS (SELECT * FROM (VALUES {alpha_rows}) AS a(alpha)),
members AS (
  SELECT view, id, label FROM parts, views WHERE split = 'train' AND fold <> left_out),
class_sizes AS (
  SELECT view, count(*)::DOUBLE AS n, (count(*) FILTER (label = 0))::DOUBLE AS n0,
         (count(*) FILTER (label = 1))::DOUBLE AS n1 FROM members GROUP BY view),
view_tf AS (SELECT view, t.* FROM tf t JOIN members USING (id)),
view_vocab AS (
  SELECT view, token, ln((n + 1) / (df + 1)) + 1 AS idf
  FROM (SELECT view, token, count(*)::DOUBLE AS df FROM view_tf GROUP BY view, token)
  JOIN class_sizes USING (view)
  WHERE df >= {min_df} AND df <= CAST(0.95 AS DOUBLE) * n),
weights AS (
  SELECT view, id, label, token, (1 + ln(tf)) * idf AS w FROM view_tf JOIN view_vocab USING (view, token)),
unit AS (
  SELECT view, label, token, w / sqrt(sum(w * w) OVER (PARTITION BY view, id)) AS x FROM weights),
class_sums AS (
  SELECT view, token, coalesce(sum(x) FILTER (label = 0), 0) AS s0,
         coalesce(sum(x) FILTER (label = 1), 0) AS s1 FROM unit GROUP BY view, token),
class_totals AS (
  SELECT view, count(*)::DOUBLE AS terms, sum(s0) AS t0, sum(s1) AS t1 FROM class_sums GROUP BY view),
params AS (
  SELECT view, alpha, token, idf, ln((s0 + alpha) / (t0 + alpha * terms)) AS lp0,
         ln((s1 + alpha) / (t1 + alpha * terms)) AS lp1
  FROM class_sums JOIN class_totals USING (view) JOIN view_vocab USING (view, token), alphas),
targets AS (
  SELECT id, label, split, fold, {scored_view} AS view FROM parts
  WHERE {'TRUE' if cv else "split = 'test'"}),
target_weights AS (
  SELECT id, t.view, tf.token, (1 + ln(tf)) * idf AS w
  FROM tf JOIN (SELECT id, view FROM targets) t USING (id) JOIN view_vocab v ON v.view = t.view AND v.token = tf.token),
target_unit AS (
  SELECT id, view, token, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS x FROM target_weights),
dots AS (
  SELECT id, alpha, sum(x * (lp1 - lp0)) AS dot FROM target_unit JOIN params USING (view, token) GROUP BY id, alpha),
margins AS (
  SELECT t.*, alpha, round(ln(n1 / n) - ln(n0 / n) + coalesce(dot, 0), 12) AS margin
  FROM targets t JOIN class_sizes USING (view) CROSS JOIN alphas LEFT JOIN dots USING (id, alpha)),
scored AS (
  SELECT id, label, split, fold, alpha, round(1 / (1 + exp(-margin)), 12) AS score,
         CASE WHEN margin > 0 THEN 1 ELSE 0 END AS prediction FROM margins)"""


def word_base(*more: str) -> str:
    return "WITH " + ",\n".join((CORPUS, PARTS, word_terms(), TF, *more)) + "\n"


def nb_test(alpha: float) -> str:
    """CTEs up to ``test_scored``: test mails with text, score and prediction of one model."""
    return word_base(
        nb((alpha,), cv=False),
        "test_scored AS (SELECT p.id, p.path, p.text, s.label, s.score, s.prediction "
        "FROM scored s JOIN parts p USING (id) WHERE s.split = 'test')",
    )


# --- metrics --------------------------------------------------------------

def rates(scored: str, by: str = "model", digits: int | None = 6) -> str:
    """Metric rows per ``by`` from rows (by, label, prediction, score)."""

    def div(a: str, b: str) -> str:
        return f"coalesce(({a})::DOUBLE / nullif({b}, 0), 0)"

    f1_ham, f1_spam = div("2 * tn", "2 * tn + fn + fp"), div("2 * tp", "2 * tp + fp + fn")
    columns = {
        "precision_ham": div("tn", "tn + fn"),
        "recall_ham": div("tn", "tn + fp"),
        "f1_ham": f1_ham,
        "precision_spam": div("tp", "tp + fp"),
        "recall_spam": div("tp", "tp + fn"),
        "f1_spam": f1_spam,
        "macro_f1": f"""(CASE WHEN tn + fp + fn > 0 THEN {f1_ham} ELSE 0 END
            + CASE WHEN tp + fp + fn > 0 THEN {f1_spam} ELSE 0 END)
            / ((tn + fp + fn > 0)::INT + (tp + fp + fn > 0)::INT)""",
        "weighted_f1": f"((tn + fp) * {f1_ham} + (fn + tp) * {f1_spam}) / (tn + fp + fn + tp)",
        "balanced_accuracy": f"""(CASE WHEN tn + fp > 0 THEN {div('tn', 'tn + fp')} ELSE 0 END
            + CASE WHEN fn + tp > 0 THEN {div('tp', 'tp + fn')} ELSE 0 END)
            / ((tn + fp > 0)::INT + (fn + tp > 0)::INT)""",
        "specificity": div("tn", "tn + fp"),
        "npv": div("tn", "tn + fn"),
        "false_positive_rate": div("fp", "fp + tn"),
        "false_negative_rate": div("fn", "fn + tp"),
        "accuracy": "(tn + tp)::DOUBLE / (tn + fp + fn + tp)",
        "roc_auc": "auc",
    }

    def out(e: str) -> str:
        return e if digits is None else f"round({e}, {digits})"

    picked = ",\n  ".join(f"{out(e)} AS {c}" for c, e in columns.items())
    return f"""cells AS (
  SELECT {by}, count(*) FILTER (label = 0 AND prediction = 0) AS tn,
         count(*) FILTER (label = 0 AND prediction = 1) AS fp,
         count(*) FILTER (label = 1 AND prediction = 0) AS fn,
         count(*) FILTER (label = 1 AND prediction = 1) AS tp FROM {scored} GROUP BY {by}),
by_score AS (
  SELECT {by}, score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg
  FROM {scored} WHERE score IS NOT NULL GROUP BY {by}, score),
auc_parts AS (
  SELECT {by}, pos, neg, pos * (coalesce(sum(neg) OVER (PARTITION BY {by} ORDER BY score
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + neg / 2.0::DOUBLE) AS won FROM by_score),
aucs AS (
  SELECT {by}, sum(won) / nullif(sum(pos)::DOUBLE * sum(neg), 0) AS auc FROM auc_parts GROUP BY {by}),
metrics AS (
  SELECT {by}, {picked}, tn + fp AS support_ham, fn + tp AS support_spam, tn, fp, fn, tp
  FROM cells LEFT JOIN aucs USING ({by}))"""


METRIC_COLUMNS = (
    "precision_ham, recall_ham, f1_ham, support_ham, precision_spam, recall_spam, f1_spam, "
    "support_spam, macro_f1, weighted_f1, balanced_accuracy, specificity, npv, "
    "false_positive_rate, false_negative_rate, roc_auc, accuracy, tn, fp, fn, tp"
)


def keyword_hit(text: str) -> str:
    found = " OR ".join(f"contains(lower({text}), {quoted(k)})" for k in KEYWORDS)
    return f"CASE WHEN {found} THEN 1 ELSE 0 END"


MAJORITY = (
    "(SELECT label FROM parts WHERE split = 'train' GROUP BY label "
    "ORDER BY count(*) DESC, label LIMIT 1)"
)


def board() -> str:
    """CTEs up to ``metrics`` and ``rows``: both baselines and the tuned Naive Bayes."""
    return word_base(
        nb(),
        """fold_f1 AS (
  SELECT alpha, fold, coalesce(2.0::DOUBLE * count(*) FILTER (label = 1 AND prediction = 1)
         / nullif(2 * count(*) FILTER (label = 1 AND prediction = 1)
                  + count(*) FILTER (label <> prediction), 0), 0) AS f1
  FROM scored WHERE split = 'train' GROUP BY alpha, fold),
grid AS (SELECT alpha, avg(f1) AS cv_f1 FROM fold_f1 GROUP BY alpha),
chosen AS (SELECT alpha, cv_f1 FROM grid ORDER BY round(cv_f1, 12) DESC, alpha LIMIT 1)""",
        f"""candidates AS (
  SELECT 'majority' AS model, id, label, {MAJORITY} AS prediction, CAST(NULL AS DOUBLE) AS score
  FROM parts WHERE split = 'test'
  UNION ALL
  SELECT 'keyword', id, label, {keyword_hit('text')}, NULL FROM parts WHERE split = 'test'
  UNION ALL
  SELECT 'nb', id, label, prediction, score FROM scored JOIN chosen USING (alpha) WHERE split = 'test')""",
        rates("candidates"),
        """rows AS (
  SELECT m.*, CASE WHEN model = 'nb' THEN (SELECT round(cv_f1, 6) FROM chosen) END AS cv_best_f1,
         CASE WHEN model = 'nb' THEN (SELECT '{"clf__alpha": ' || alpha || '}' FROM chosen) END AS best_params,
         CASE model WHEN 'majority' THEN 0 WHEN 'keyword' THEN 1 ELSE 2 END AS model_order
  FROM metrics m)""",
    )


def display(model: str) -> str:
    cases = " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in MODEL_LABELS.items())
    return f"CASE {model} {cases} ELSE {model} END"
