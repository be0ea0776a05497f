"""One DuckDB statement per registered query that SQL can express."""

from __future__ import annotations

from mailspark.config import ENGLISH_STOP_WORDS, NB_ALPHAS
from oracle import sql

ALPHA = 0.1
LOW = 0.16
NAME = "CASE WHEN {} = 1 THEN 'spam' ELSE 'ham' END"
LOW_SCORED = (
    f"low_scored AS (SELECT *, CASE WHEN score >= {LOW} THEN 1 ELSE 0 END AS decided FROM test_scored), "
    "low AS (SELECT id, path, text, label, score, decided AS prediction, 'nb_low_threshold' AS model FROM low_scored)"
)
CORPUS = f"WITH {sql.CORPUS} "
PARTS = f"WITH {sql.CORPUS}, {sql.PARTS} "


def nb_test(*more: str) -> str:
    return ", ".join((sql.nb_test(ALPHA), *more)) + "\n"


def low(*more: str) -> str:
    return nb_test(LOW_SCORED, *more)


KEYWORD_SCORED = (
    f"WITH {sql.CORPUS}, keyword_scored AS (SELECT 'keyword' AS model, *, {sql.keyword_hit('text')} AS prediction, "
    "CAST(NULL AS DOUBLE) AS score FROM corpus), " + sql.rates("keyword_scored") + "\n"
)


def errors_of(scored: str, score: str = "score") -> str:
    squeezed = sql.sub("text", rf"[{sql.WS}]+", " ")
    return f"""SELECT id, path, {NAME.format('label')} AS true_name, {NAME.format('prediction')} AS predicted_name,
  round({score}, 6) AS score, round(abs({score}), 6) AS confidence, length(text) AS length_chars,
  len([w FOR w IN regexp_extract_all(text, '[^{sql.WS}]+')]) AS length_words,
  substr({squeezed}, 1, 220) AS text_preview
FROM {scored} WHERE label <> prediction"""


REPORT = """SELECT 'ham' AS class, precision_ham AS precision, recall_ham AS recall, f1_ham AS f1_score, support_ham AS support FROM metrics
UNION ALL SELECT 'spam', precision_spam, recall_spam, f1_spam, support_spam FROM metrics
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), n FROM raw
UNION ALL SELECT 'weighted avg', round((n0 * p0 + n1 * p1) / n, 6), round((n0 * r0 + n1 * r1) / n, 6), round((n0 * f0 + n1 * f1) / n, 6), n FROM raw
UNION ALL SELECT 'accuracy', NULL, NULL, accuracy, support_ham + support_spam FROM metrics"""
RAW = """raw AS (
  SELECT coalesce(tn::DOUBLE / nullif(tn + fn, 0), 0) AS p0, coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0) AS p1,
         coalesce(tn::DOUBLE / nullif(tn + fp, 0), 0) AS r0, coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0) AS r1,
         coalesce(2.0::DOUBLE * tn / nullif(2 * tn + fn + fp, 0), 0) AS f0,
         coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1,
         tn + fp AS n0, fn + tp AS n1, tn + fp + fn + tp AS n FROM cells)"""

TOKENS = f"""WITH found AS (
  SELECT doc_id, regexp_extract_all(clean, '[\\p{{L}}\\p{{N}}_]+') AS tokens
  FROM (SELECT doc_id, {sql.clean('text')} AS clean FROM documents)) """

TERM_LIST = """SELECT id, len(terms) AS n, len(list_distinct(terms)) AS n_distinct,
  md5(array_to_string(list_sort(terms), '|')) AS terms_md5 FROM terms"""


def terms_base(terms: str, source_ctes: str = f"{sql.CORPUS}, {sql.PARTS}") -> str:
    return f"WITH {source_ctes},\n{terms},\n{sql.TF}"


def stats_sql() -> str:
    def one(name: str, terms: str, min_df: int, prefix: str) -> tuple[str, str]:
        ctes = f"""{terms},
{prefix}tf AS (SELECT id, split, unnest(list_distinct(terms)) AS token FROM {prefix}terms),
{prefix}df AS (SELECT token, count(*)::DOUBLE AS df FROM {prefix}tf WHERE split = 'train' GROUP BY token),
{prefix}vocab AS (SELECT df FROM {prefix}df, train_size WHERE df >= {min_df} AND df <= CAST(0.95 AS DOUBLE) * n)"""
        row = f"""SELECT '{name}' AS config, (SELECT n::BIGINT FROM train_size) AS docs, count(*) AS vocabulary,
  sum(df)::BIGINT AS nnz, round(sum(df) / ((SELECT n FROM train_size) * count(*)), 6) AS density FROM {prefix}vocab"""
        return ctes, row

    plain = f"""p_clean AS (SELECT id, split, {sql.clean('text')} AS clean FROM parts),
p_terms AS (SELECT id, split, regexp_extract_all(clean, '[\\p{{L}}\\p{{N}}_]+') AS terms FROM p_clean)"""
    blocks = [
        one("word_1_2", sql.word_terms(name="w_terms"), 2, "w_"),
        one("unigrams_with_stop_words", plain, 2, "p_"),
        one("char_3_5", sql.char_terms(name="c_terms"), 3, "c_"),
    ]
    ctes = ",\n".join(b[0] for b in blocks)
    return (
        f"WITH {sql.CORPUS}, {sql.PARTS}, train_size AS (SELECT count(*)::DOUBLE AS n FROM parts WHERE split = 'train'),\n"
        f"{ctes}\n" + "\nUNION ALL ".join(b[1] for b in blocks)
    )


def experiment_sql() -> str:
    """The tuned Naive Bayes on test mails, under word terms and under character terms."""

    def one(name: str, terms: str, min_df: int) -> str:
        return f"""SELECT * FROM (WITH {terms}, {sql.TF}, {sql.nb(min_df=min_df)},
fold_f1 AS (
  SELECT alpha, fold, coalesce(2.0::DOUBLE * count(*) FILTER (label = 1 AND prediction = 1)
         / nullif(2 * count(*) FILTER (label = 1 AND prediction = 1) + count(*) FILTER (label <> prediction), 0), 0) AS f1
  FROM scored WHERE split = 'train' GROUP BY alpha, fold),
chosen AS (SELECT alpha, avg(f1) AS cv_f1 FROM fold_f1 GROUP BY alpha ORDER BY round(cv_f1, 12) DESC, alpha LIMIT 1),
picked AS (SELECT 'nb' AS model, s.* FROM scored s JOIN chosen USING (alpha) WHERE split = 'test'),
{sql.rates('picked')}
SELECT '{name}' AS experiment, model, '{{"clf__alpha": ' || (SELECT alpha FROM chosen) || '}}' AS best_params,
  (SELECT round(cv_f1, 6) FROM chosen) AS cv_best_f1, f1_spam, accuracy, roc_auc, tn, fp, fn, tp FROM metrics) {name}"""

    return (
        PARTS
        + one("word_1_2", sql.word_terms(), 2)
        + "\nUNION ALL\n"
        + one("char_3_5", sql.char_terms(), 3)
    )


FOLDS = """fold_f1 AS (
  SELECT alpha, fold, coalesce(2.0::DOUBLE * count(*) FILTER (label = 1 AND prediction = 1)
         / nullif(2 * count(*) FILTER (label = 1 AND prediction = 1) + count(*) FILTER (label <> prediction), 0), 0) AS f1
  FROM scored WHERE split = 'train' GROUP BY alpha, fold)"""


def contributions_sql() -> str:
    return nb_test(
        """model AS (SELECT token, idf, lp1 - lp0 AS odds FROM params WHERE view = 'final'),
w AS (SELECT id, token, (1 + ln(tf)) * idf AS w, odds FROM tf JOIN model USING (token) WHERE split = 'test'),
c AS (SELECT id, token, round(w / sqrt(sum(w * w) OVER (PARTITION BY id)) * odds, 12) AS contribution FROM w),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY contribution DESC, token) AS high,
             row_number() OVER (PARTITION BY id ORDER BY contribution, token) AS low FROM c)""",
    ) + """SELECT id, 'spam' AS side, high AS place, token, round(contribution, 6) AS contribution FROM r WHERE high <= 12
UNION ALL SELECT id, 'ham', low, token, round(contribution, 6) FROM r WHERE low <= 12"""


def top_tokens_sql() -> str:
    return nb_test(
        """model AS (SELECT token, round(lp1 - lp0, 12) AS weight FROM params WHERE view = 'final'),
r AS (SELECT *, row_number() OVER (ORDER BY weight DESC, token) AS high,
             row_number() OVER (ORDER BY weight, token) AS low FROM model)""",
    ) + """SELECT 'spam' AS side, high AS place, token, round(weight, 6) AS weight FROM r WHERE high <= 15
UNION ALL SELECT 'ham', low, token, round(weight, 6) FROM r WHERE low <= 15"""


def compared_ctes() -> str:
    return sql.word_base(
        sql.nb(cv=False),
        f"""compared AS (
  SELECT id, label, 'keyword' AS model, 0 AS model_order, {sql.keyword_hit('text')} AS prediction,
         CAST(NULL AS DOUBLE) AS score, 'none' AS score_type FROM parts WHERE split = 'test'
  UNION ALL
  SELECT id, label, 'nb ' || alpha, list_position({list(NB_ALPHAS)}::DOUBLE[], alpha), prediction, score, 'Spam probability'
  FROM scored)""",
        sql.rates("compared"),
        f"""decided AS (
  SELECT c.*, CASE WHEN model = 'nb 0.1' THEN CASE WHEN score >= {LOW} THEN 1 ELSE 0 END ELSE c.prediction END AS final
  FROM compared c)""",
    )


MODEL_LABEL = sql.display("model")


LINEAR_FACTS = ("chosen_from_grid", "residuals_cancel", "gradient_vanishes", "gap_closed")


def model_facts(*more: str) -> str:
    """Per test mail what must hold of its score, whatever the solver finds."""
    facts = ", ".join(f"true AS {f}" for f in ("in_range", "agrees", "metrics_follow", *more))
    return PARTS + f"SELECT id, label, {facts} FROM parts WHERE split = 'test'"


def first_split_sql(best: str) -> str:
    """The best split of all train mails, over the bins of all terms: ``up`` has those of a
    bin and above, ``in`` those of the term in any bin."""
    return sql.word_base(
        sql.vocab(),
        """w AS (SELECT id, token, (1 + ln(tf)) * idf AS w FROM tf JOIN vocab USING (token) WHERE split = 'train'),
x AS (SELECT id, token, floor(ln(w / sqrt(sum(w * w) OVER (PARTITION BY id))) / ln(1.25::DOUBLE))::INTEGER AS bin FROM w),
bins AS (SELECT token, bin, count(*)::DOUBLE AS n, sum(label)::DOUBLE AS g FROM x JOIN parts USING (id) GROUP BY ALL),
scanned AS (SELECT sum(n) OVER up AS up_n, sum(g) OVER up AS up_g, sum(n) OVER term AS in_n, sum(g) OVER term AS in_g
  FROM bins WINDOW up AS (PARTITION BY token ORDER BY bin DESC), term AS (PARTITION BY token)),
totals AS (SELECT count(*)::DOUBLE AS n, sum(label)::DOUBLE AS g FROM parts WHERE split = 'train')""",
    ) + best


def queries() -> dict[str, str]:
    step = sql.step_query
    file_text = sql.stripped("'doc' || chr(10) || text")
    folds_csv = f"WITH {sql.CORPUS}, kept AS (SELECT min(label) AS label, text FROM corpus GROUP BY text) "
    board = sql.board()
    stop_list = "[" + ", ".join(sql.quoted(w) for w in ENGLISH_STOP_WORDS) + "]"
    unescaped = (
        "regexp_replace(replace(replace(replace({0}, '&quot;', '\"'), '&copy;', chr(169)), '&middot;', chr(183)), "
        "'&amp;?', '&', 'g')"
    )
    html_mail = (
        unescaped.format(sql.tags("html || chr(10)"))
    )
    return {
        "record_ids": CORPUS + "SELECT id, label, label_name, path, md5(text) AS text_md5 FROM corpus",
        "limited_load": CORPUS + "SELECT id, label, path FROM corpus ORDER BY label, path LIMIT 60",
        "folder_load": CORPUS
        + f"SELECT label, label_name, 'doc' AS subject, md5({file_text}) AS text_md5 FROM corpus",
        "streamed_mail_files": f"""{CORPUS} SELECT md5(t) AS text_md5, {sql.keyword_hit('t')} AS prediction,
  {NAME.format(sql.keyword_hit('t'))} AS predicted_name FROM (SELECT {file_text} AS t FROM corpus)""",
        "linear_svm": model_facts(*LINEAR_FACTS),
        "logistic_regression": model_facts(*LINEAR_FACTS),
        "random_forest": model_facts("point_of_grid", "beats_constant"),
        "gradient_boosted_trees": model_facts("point_of_grid", "loss_falls", "loss_is_halved"),
        "forest_first_split": first_split_sql(
            """SELECT n::BIGINT AS mails, round(g / n, 6) AS spam_share, round(max(
  (g - up_g) * (g - up_g) / (n - up_n) + up_g * up_g / up_n - g * g / n), 6) AS gain
FROM scanned, totals WHERE n > up_n GROUP BY n, g"""
        ),
        "boosting_first_split": first_split_sql(
            """, sides AS (
  SELECT (n / 2 - g) AS all_g, n / 4 AS all_h, up_n / 2 - up_g AS right_g, up_n / 4 AS right_h FROM scanned, totals
  UNION ALL SELECT n / 2 - g, n / 4, (n - in_n + up_n) / 2 - (g - in_g + up_g), (n - in_n + up_n) / 4 FROM scanned, totals)
SELECT round(max((all_g - right_g) * (all_g - right_g) / (all_h - right_h + 1) + right_g * right_g / (right_h + 1)
  - all_g * all_g / (all_h + 1)), 6) AS gain, round(ln(2), 6) AS first_loss, true AS loss_falls
FROM sides WHERE right_h >= 1 AND all_h - right_h >= 1"""
        ),
        "experiment_grid": f"""WITH nb AS ({experiment_sql()})
SELECT experiment, model, tn + fp + fn + tp AS mails, true AS f1_follows, true AS accuracy_follows, true AS cv_in_range,
  f1_spam AS nb_f1_spam, cv_best_f1 AS nb_cv_best_f1 FROM nb
UNION ALL SELECT experiment, 'svm', tn + fp + fn + tp, true, true, true, NULL, NULL FROM nb""",
        "nb_config_choice": f"""WITH nb AS ({experiment_sql()})
SELECT experiment, CAST(json_extract_string(best_params, '$.clf__alpha') AS DOUBLE) AS alpha, cv_best_f1
FROM nb ORDER BY cv_best_f1 DESC, experiment DESC LIMIT 1""",
        "delimited_file_load": folds_csv
        + f"SELECT label, {NAME.format('label')} AS label_name, md5(text) AS text_md5 FROM kept",
        "null_drop_and_cast": "SELECT CAST(toxic AS INTEGER) AS label, count(*) AS rows, sum(length(text))::BIGINT AS chars "
        "FROM documents JOIN labels USING (doc_id) WHERE toxic IS NOT NULL GROUP BY 1",
        "saved_split_tables": PARTS + "SELECT id, path, split, fold FROM parts",
        "reloaded_model": nb_test()
        + "SELECT id, label, round(score, 6) AS score, prediction FROM test_scored",
        "parsed_mail_bytes": "SELECT conv_id, turn, role AS subject, text AS body FROM conversations",
        "parsed_html_mails": f"SELECT page_id, 'page' AS subject, md5({unescaped.format(sql.tags('html'))}) AS body_md5 FROM pages",
        "composed_texts": f"SELECT conv_id, turn, {sql.stripped('role || chr(10) || text')} AS text FROM conversations",
        "decoded_bytes": "SELECT doc_id, md5(text) AS text_md5 FROM documents",
        "html_to_text": f"SELECT page_id, {unescaped.format(sql.tags('html'))} AS text FROM pages",
        "clean_nfkc": step("nfc_normalize(text)")
        + " UNION ALL SELECT 'literals', * FROM (VALUES (-11, 'ABC123'), (-12, 'fine office'), "
        "(-13, 'x2 1' || chr(8260) || '2 1'), (-14, chr(12460)), (-15, chr(197) || ' ' || chr(937))) v(id, text)",
        "clean_newlines": step(sql.newlines("text")),
        "clean_header_lines": step(sql.header_lines("text")),
        "clean_lower_case": step(sql.lower("text")),
        "clean_urls": step(sql.urls("text")),
        "clean_addresses": step(sql.addresses("text")),
        "clean_money": step(sql.money("text")),
        "clean_numbers": step(sql.numbers("text")),
        "clean_base64_runs": step(sql.base64_runs("text")),
        "clean_tags": step(sql.tags("text")),
        "clean_punctuation": step(sql.punctuation("text")),
        "clean_spaces": step(f"trim({sql.spaces('text')})"),
        "clean_text": f"WITH {sql.TEXTS} SELECT kind, id, {sql.clean('text')} AS clean FROM texts",
        "clean_conversations": f"SELECT conv_id, turn, {sql.clean('text')} AS clean FROM conversations",
        "content_dedup": f"WITH {sql.CORPUS}, {sql.DEDUP} SELECT id, label, path FROM unique_mails",
        "dataset_views": f"""WITH {sql.CORPUS}, {sql.DEDUP}
SELECT 'loaded_without_dedup' AS dataset_view, count(*) AS rows, count(*) FILTER (label = 0) AS ham, count(*) FILTER (label = 1) AS spam FROM corpus
UNION ALL SELECT 'loaded_with_dedup', count(*), count(*) FILTER (label = 0), count(*) FILTER (label = 1) FROM unique_mails""",
        "parse_preview": f"""WITH {sql.CORPUS}, firsts AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY label_name ORDER BY path, id) AS rn FROM corpus) WHERE rn = 1)
SELECT label_name AS label, string_split(path, '/')[-1] AS file, '' AS subject,
  substr(text, 1, 240) AS raw_preview, substr({sql.clean('text')}, 1, 240) AS clean_preview FROM firsts""",
        "word_tokens": TOKENS + "SELECT doc_id, len(tokens) AS n, array_to_string(tokens, ' ') AS tokens FROM found",
        "stop_word_table": f"""WITH words AS (SELECT unnest({stop_list}) AS token, true AS english, false AS listed
  UNION ALL SELECT lower(n_name), false, true FROM nation UNION ALL SELECT 'the', false, true)
SELECT token, bool_or(english) AS english, bool_or(listed) AS listed FROM words GROUP BY token""",
        "stop_word_removal": TOKENS
        + f"SELECT doc_id, array_to_string([t FOR t IN tokens IF NOT list_contains({stop_list}, t)], ' ') AS kept FROM found",
        "word_ngrams": f"WITH {sql.CORPUS}, {sql.word_terms('corpus')} {TERM_LIST}",
        "char_ngrams": f"WITH {sql.CORPUS}, {sql.char_terms('corpus')} {TERM_LIST}",
        "word_vocabulary": sql.word_base(sql.vocab())
        + "SELECT token, df::BIGINT AS df, round(idf, 6) AS idf FROM vocab",
        "char_vocabulary": terms_base(sql.char_terms())
        + f", {sql.vocab(3)} SELECT token, df::BIGINT AS df, round(idf, 6) AS idf FROM vocab",
        "tfidf_weights": sql.word_base(sql.vocab())
        + """, w AS (SELECT id, token, tf, (1 + ln(tf)) * idf AS w FROM tf JOIN vocab USING (token) WHERE split = 'train')
SELECT id, token, tf, round(w / sqrt(sum(w * w) OVER (PARTITION BY id)), 6) AS weight FROM w""",
        "idf_ranking": sql.word_base(sql.vocab())
        + """, r AS (SELECT token, idf, row_number() OVER (ORDER BY idf, token) AS low, row_number() OVER (ORDER BY idf DESC, token) AS high FROM vocab)
SELECT 'lowest' AS "end", low AS place, token, round(idf, 6) AS idf FROM r WHERE low <= 10
UNION ALL SELECT 'highest', high, token, round(idf, 6) FROM r WHERE high <= 10""",
        "feature_matrix_stats": stats_sql(),
        "stratified_split": PARTS + "SELECT id, label, split FROM parts",
        "fold_assignment": PARTS + "SELECT id, label, fold FROM parts WHERE split = 'train'",
        "split_counts": PARTS
        + "SELECT split, count(*) AS rows, count(*) FILTER (label = 0) AS ham, count(*) FILTER (label = 1) AS spam FROM parts GROUP BY split",
        "split_label_counts": PARTS
        + "SELECT split, label_name AS label, count(*) AS count FROM parts GROUP BY ALL",
        "label_counts": CORPUS
        + "SELECT coalesce(label_name, 'total') AS label, count(*) AS raw_file_count FROM corpus GROUP BY ROLLUP (label_name)",
        "random_sample": CORPUS
        + """SELECT id, label_name, text FROM (SELECT *, row_number() OVER (PARTITION BY label_name ORDER BY md5('42:' || id)) AS rn FROM corpus)
WHERE rn = 1""",
        "majority_baseline": PARTS
        + f"SELECT id, label, {sql.MAJORITY} AS prediction FROM parts WHERE split = 'test'",
        "keyword_baseline": CORPUS + f"SELECT id, label, {sql.keyword_hit('text')} AS prediction FROM corpus",
        "nb_model": nb_test()
        + """SELECT token, round(idf, 6) AS idf, round(lp0, 6) AS log_prob_ham, round(lp1, 6) AS log_prob_spam,
  round(lp1 - lp0, 6) AS weight FROM params WHERE view = 'final'""",
        "nb_fold_scores": sql.word_base(sql.nb(), FOLDS)
        + "SELECT alpha, fold, round(f1, 6) AS f1_spam FROM fold_f1",
        "nb_grid_search": sql.word_base(sql.nb(), FOLDS)
        + "SELECT alpha, round(avg(f1), 6) AS cv_f1 FROM fold_f1 GROUP BY alpha",
        "nb_experiments": experiment_sql(),
        "leaderboard": board + f"SELECT model, {sql.METRIC_COLUMNS}, cv_best_f1, best_params FROM rows",
        "best_model": board
        + "SELECT model, f1_spam, best_params FROM rows WHERE model NOT IN ('majority', 'keyword') ORDER BY f1_spam DESC, model_order LIMIT 1",
        "nb_scores": nb_test() + "SELECT id, label, round(score, 6) AS score, prediction FROM test_scored",
        "threshold_decisions": low() + "SELECT id, label, prediction FROM low",
        "low_confidence_flags": nb_test()
        + f"""SELECT id, abs(score - CAST(0.5 AS DOUBLE)) < CAST(0.12 AS DOUBLE) AS near_default,
  abs(score - CAST({LOW} AS DOUBLE)) < CAST(0.12 AS DOUBLE) AS near_low FROM test_scored""",
        "confusion_counts": KEYWORD_SCORED + "SELECT tn, fp, fn, tp FROM cells",
        "confusion_matrix": low(sql.rates("low"))
        + "SELECT 'true_ham' AS actual, tn AS pred_ham, fp AS pred_spam FROM cells UNION ALL SELECT 'true_spam', fn, tp FROM cells",
        "class_precision_recall": KEYWORD_SCORED
        + "SELECT precision_ham, recall_ham, f1_ham, support_ham, precision_spam, recall_spam, f1_spam, support_spam FROM metrics",
        "accuracies": KEYWORD_SCORED + "SELECT accuracy, balanced_accuracy FROM metrics",
        "error_rates": KEYWORD_SCORED
        + "SELECT specificity, npv, false_positive_rate, false_negative_rate FROM metrics",
        "averaged_f1": KEYWORD_SCORED + "SELECT macro_f1, weighted_f1 FROM metrics",
        "roc_auc": low(sql.rates("low")) + "SELECT roc_auc FROM metrics",
        "metric_row": low(sql.rates("low")) + f"SELECT model, {sql.METRIC_COLUMNS} FROM metrics",
        "classification_report": low(sql.rates("low"), RAW) + REPORT,
        "error_analysis": low() + errors_of("low"),
        "keyword_errors": KEYWORD_SCORED + errors_of("keyword_scored"),
        "top_errors": low()
        + errors_of("low")
        + " ORDER BY abs(low.score) DESC, length_words DESC, id LIMIT 10",
        "token_contributions": contributions_sql(),
        "top_tokens": top_tokens_sql(),
        "model_comparison": compared_ctes()
        + f"""SELECT d.id, model_order AS "order", CASE WHEN model = 'nb 0.1' THEN 'Primary demo' ELSE 'Compare' END AS role,
  model, {NAME.format('final')} AS prediction, round(score, 6) AS score, score_type,
  CASE WHEN model = 'nb 0.1' THEN 'custom threshold' ELSE 'model default' END AS threshold_mode,
  accuracy AS test_accuracy, f1_spam AS test_f1_spam, final = label AS match_expected
FROM (SELECT id, label, model, model_order, score, score_type, final FROM decided) d
JOIN (SELECT model, accuracy, f1_spam FROM metrics) m USING (model)""".replace(
            "  model, CASE", "  CASE WHEN model = 'keyword' THEN 'Keyword Baseline' ELSE model END AS model, CASE"
        ),
        "vote_summary": compared_ctes()
        + """SELECT id, count(*) AS models_compared, count(*) FILTER (final = 1) AS spam_votes,
  count(*) FILTER (final = 0) AS ham_votes, count(*) FILTER (final = label) AS matches_expected FROM decided GROUP BY id""",
        "leader_summary": board
        + f""", placed AS (SELECT *, {MODEL_LABEL} AS model_label, row_number() OVER (ORDER BY f1_spam DESC, model) AS place FROM rows),
g AS (SELECT max(f1_spam * 100) FILTER (place = 1) AS top, max(f1_spam * 100) FILTER (place = 2) AS second,
  max(f1_spam * 100) FILTER (model = 'nb') AS nb, max(accuracy * 100) FILTER (place = 1) AS acc,
  max(model_label) FILTER (place = 1) AS leader, max(model_label) FILTER (place = 2) AS runner_up FROM placed)
SELECT leader, round(top, 6) AS leader_f1_pct, round(acc, 6) AS leader_accuracy_pct, runner_up,
  round(second, 6) AS runner_up_f1_pct, round(coalesce(top - second, 0), 6) AS margin, round(top - nb, 6) AS gap_to_nb,
  CAST(NULL AS DOUBLE) AS gap_to_lr, round(nb, 6) AS primary_f1_pct, round(top - nb, 6) AS gap_to_primary FROM g""",
        "leaderboard_display": board
        + f"""SELECT model, {MODEL_LABEL} AS model_label, round(precision_spam * 100, 6) AS precision_pct, round(recall_spam * 100, 6) AS recall_pct,
  round(f1_spam * 100, 6) AS f1_pct, round(accuracy * 100, 6) AS accuracy_pct FROM rows""",
        "leaderboard_rows": board
        + """SELECT * FROM (SELECT 'best' AS wanted, model, f1_spam, accuracy FROM rows ORDER BY f1_spam DESC, model LIMIT 1)
UNION ALL SELECT 'keyword', model, f1_spam, accuracy FROM rows WHERE model = 'keyword'""",
        "streamed_keyword_scores": f"""SELECT id, prediction, {NAME.format('prediction')} AS predicted_name FROM (
  SELECT sha1(CAST(doc_id AS VARCHAR)) AS id, {sql.keyword_hit('text')} AS prediction FROM documents)""",
        "streamed_nb_scores": streamed_nb_sql(),
    }


def streamed_nb_sql() -> str:
    """All documents under the model trained on the labelled ones."""
    everything = "all_mails AS (SELECT sha1(CAST(doc_id AS VARCHAR)) AS id, text FROM documents)"
    return sql.word_base(
        sql.nb((ALPHA,), cv=False),
        everything,
        sql.word_terms("all_mails", "all_terms"),
        """all_tf AS (SELECT id, token, count(*) AS tf FROM (SELECT id, unnest(terms) AS token FROM all_terms) GROUP BY ALL),
all_w AS (SELECT id, (1 + ln(tf)) * idf AS w, lp1 - lp0 AS odds FROM all_tf JOIN params USING (token) WHERE view = 'final'),
all_dots AS (SELECT id, sum(w * odds) / sqrt(sum(w * w)) AS dot FROM all_w GROUP BY id),
all_margins AS (SELECT id, round(ln(n1 / n) - ln(n0 / n) + coalesce(dot, 0), 12) AS margin
  FROM all_mails CROSS JOIN class_sizes LEFT JOIN all_dots USING (id) WHERE view = 'final')""",
    ) + """SELECT id, round(round(1 / (1 + exp(-margin)), 12), 6) AS score, CASE WHEN margin > 0 THEN 1 ELSE 0 END AS prediction
FROM all_margins"""
