"""The registered queries: every operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailspark.config import (
    CHAR_3_5,
    ENGLISH_STOP_WORDS,
    EXPERIMENTS,
    NB_ALPHAS,
    WORD_1_2,
    FeatureConfig,
)
from mailspark.functions import clean
from mailspark.functions.mail import compose_text, decode_text, html_to_text, parse_mails
from mailspark.functions.terms import term_documents, without_stop_words, word_tokens
from mailspark.operators import boosting, forest, naive_bayes
from mailspark.operators.baselines import keyword_predictions, majority_predictions
from mailspark.operators.blocks import Blocks, term_products
from mailspark.operators.classifiers import GRIDS, linear_point
from mailspark.operators.compare import model_comparison, vote_summary
from mailspark.operators.dedup import drop_repeated_texts
from mailspark.operators.errors import error_analysis
from mailspark.operators.explain import token_contributions, top_tokens
from mailspark.operators.features import (
    idf_extremes,
    matrix_stats,
    prepared_terms,
    tfidf,
    vocabulary,
)
from mailspark.operators.leaderboard import (
    best_model,
    best_row,
    leader_summary,
    leaderboard,
    leaderboard_display,
    row_of,
)
from mailspark.operators.linear import TOLERANCE
from mailspark.operators.metrics import (
    add_rates,
    classification_report,
    confusion,
    confusion_matrix,
    metric_row,
    metric_rows,
    roc_auc,
    rounded,
)
from mailspark.operators.scoring import near_threshold, threshold_predictions
from mailspark.operators.split import (
    assign_parts,
    label_counts,
    parse_preview,
    sample_mail,
    split_counts,
    split_label_counts,
)
from mailspark.operators.trees import ROOT
from mailspark.plans import train
from mailspark.plans.model import DECISION, MailModel, load_model, save_model
from mailspark.sources.mails import file_tasks, first_mails, labelled_frame, load_mails
from mailspark.sources.reports import read_report, save_table
from mailspark.sources.scratch import scratch_path, written
from mailspark.sources.stop_words import read_stop_words, stop_words
from mailspark.sources.tables import labelled_documents, read_table, spread
from mailspark.streaming.score import mail_file_stream, score_stream, scored_rows, table_stream

Query = Callable[[SparkSession, str], DataFrame]
ALPHA = 0.1
LOW_THRESHOLD = 0.16

LITERALS = (
    (-1, "From: a@b.c\r\nhi http://x.y/z $ 5,000.5 !!!!! 12.5 a1 1a a_1 <b>x</b>"),
    (-2, "subject : re\rTo: q\nz"),
    (-3, "tiền 10%/tháng 100.000.000 đ"),
    (-4, "A" * 41 + "=="),
    (-5, "x from: y"),
    (-6, '<a href="http://x.y">click</a> b > c'),
)

NFKC_LITERALS = (
    (-11, "ＡＢＣ１２３"),
    (-12, "ﬁne oﬃce"),
    (-13, "x² ½ ①"),
    (-14, "ｶﾞ"),
    (-15, "\u212b\u00a0\u2126"),
)
FILE_SUBJECT = "doc"


# --- corpus -----------------------------------------------------------------


def digest(text: str) -> Column:
    return F.md5(F.col(text).cast("binary"))


def record_ids(spark: SparkSession, sf: str) -> DataFrame:
    return labelled_documents(spark, sf).select(
        "id", "label", "label_name", "path", digest("text").alias("text_md5")
    )


def limited_load(spark: SparkSession, sf: str) -> DataFrame:
    return first_mails(labelled_documents(spark, sf), 60).select("id", "label", "path")


def delimited_file_load(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "mails") + ".csv"
    rows = labelled_documents(spark, sf).select(F.col("text").alias("raw_text"), "label")
    save_table(rows, path, "csv")
    return load_mails(spark, path, dedup=True).select("label", "label_name", digest("text").alias("text_md5"))


def mail_folders(spark: SparkSession, sf: str) -> str:
    """The labelled documents as one mail file each, in a folder for each label.

    A folder for each mail would be made, moved and listed one by one.
    """
    base = scratch_path(spark, "mail-folders")
    mails = labelled_documents(spark, sf)
    head = F.lit(f"Subject: {FILE_SUBJECT}\n\n")
    for name in ("ham", "spam"):
        texts_of = F.collect_list(F.concat(head, "text"))  # one, unless rows repeat an id
        some = mails.where(F.col("label_name") == name)
        some.repartition(file_tasks(spark), "id").groupBy("id").agg(
            F.array_join(texts_of, "\n").alias("value")
        ).select("value").write.option("maxRecordsPerFile", 1).text(f"{base}/{name}")
    return base


def folder_load(spark: SparkSession, sf: str) -> DataFrame:
    mails = load_mails(spark, mail_folders(spark, sf))
    return mails.select("label", "label_name", "subject", digest("text").alias("text_md5"))


def labelled_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Null texts dropped, label cast, over all documents with and without a label."""
    documents = read_table(spark, sf, "documents").join(
        read_table(spark, sf, "labels"), "doc_id", "left"
    )
    frame = documents.select(
        F.when(F.col("toxic").isNotNull(), F.col("text")).alias("raw_text"),
        F.col("toxic").cast("string").alias("label"),
    )
    return labelled_frame(frame).groupBy("label").agg(
        F.count("*").alias("rows"), F.sum(F.length("text")).alias("chars")
    )


def saved_split_tables(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "parts")
    parts = assign_parts(labelled_documents(spark, sf))
    save_table(parts, path)
    saved = read_report(spark, path, parts.schema)
    never = read_report(spark, f"{path}-never-written", parts.schema)
    return saved.unionByName(never).select("id", "path", "split", "fold")


def composed_texts(spark: SparkSession, sf: str) -> DataFrame:
    turns = read_table(spark, sf, "conversations")
    text = compose_text(F.col("role"), F.col("text"))
    return turns.select("conv_id", "turn", text.alias("text")).where(F.length("text") > 0)


def parsed_mail_bytes(spark: SparkSession, sf: str) -> DataFrame:
    turns = read_table(spark, sf, "conversations")
    raw = F.concat(F.lit("Subject: "), "role", F.lit("\n\n"), "text")
    return parse_mails(turns.select("conv_id", "turn", F.encode(raw, "UTF-8").alias("content")))


def parsed_html_mails(spark: SparkSession, sf: str) -> DataFrame:
    """Pages as the html part of two-part mails that also carry an attachment."""
    head = (
        "Subject: page\nMIME-Version: 1.0\nContent-Type: multipart/mixed; boundary=cut\n\n"
        "--cut\nContent-Type: text/html; charset=utf-8\nContent-Transfer-Encoding: 8bit\n\n"
    )
    tail = (
        "\n--cut\nContent-Type: text/plain\nContent-Disposition: attachment; filename=a.txt\n\n"
        "attached\n--cut--\n"
    )
    plain_tail = tail.replace("text/plain", "application/octet-stream")
    pages = read_table(spark, sf, "pages")
    raw = F.concat(F.lit(head), "html", F.lit(plain_tail))
    mails = parse_mails(pages.select("page_id", F.encode(raw, "UTF-8").alias("content")))
    return mails.select("page_id", "subject", digest("body").alias("body_md5"))


def decoded_bytes(spark: SparkSession, sf: str) -> DataFrame:
    documents = read_table(spark, sf, "documents")
    latin = ~F.col("text").rlike(r"[^\x00-\xff]")
    content = F.when(
        latin & (F.col("lang") != "en"), F.encode("text", "ISO-8859-1")
    ).otherwise(F.encode("text", "UTF-8"))
    return documents.withColumn("content", content).select(
        "doc_id", F.md5(decode_text(F.col("content")).cast("binary")).alias("text_md5")
    )


def page_texts(spark: SparkSession, sf: str) -> DataFrame:
    pages = spread(read_table(spark, sf, "pages").select("page_id", "html"), "page_id")
    return html_to_text(pages, "html", "text").select("page_id", "text")


# --- cleaning ---------------------------------------------------------------


def texts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents, page sources and a few literals that hold every pattern."""
    documents = spread(read_table(spark, sf, "documents").select("doc_id", "text"), "doc_id").select(
        F.lit("documents").alias("kind"), F.col("doc_id").alias("id"), "text"
    )
    pages = spread(read_table(spark, sf, "pages").select("page_id", "html"), "page_id").select(
        F.lit("pages").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("text")
    )
    literals = spark.createDataFrame(LITERALS, "id bigint, text string").select(
        F.lit("literals").alias("kind"), "id", "text"
    )
    return documents.unionByName(pages).unionByName(literals)


def cleaning_step(step: Callable[[Column], Column]) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return texts(spark, sf).withColumn("text", step(F.col("text")))

    return query


def nfkc_texts(spark: SparkSession, sf: str) -> DataFrame:
    literals = spark.createDataFrame(NFKC_LITERALS, "id bigint, text string")
    literals = literals.select(F.lit("literals").alias("kind"), "id", "text")
    return clean.nfkc(texts(spark, sf).unionByName(literals), "text")


def cleaned_texts(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_text(texts(spark, sf)).select("kind", "id", "clean")


def cleaned_conversations(spark: SparkSession, sf: str) -> DataFrame:
    turns = spread(read_table(spark, sf, "conversations").drop("role"), "conv_id", "turn")
    return clean.clean_text(turns).select("conv_id", "turn", "clean")


def content_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return drop_repeated_texts(labelled_documents(spark, sf)).select("id", "label", "path")


def dataset_views(spark: SparkSession, sf: str) -> DataFrame:
    mails = labelled_documents(spark, sf)
    views = mails.withColumn("dataset_view", F.lit("loaded_without_dedup")).unionByName(
        drop_repeated_texts(mails).withColumn("dataset_view", F.lit("loaded_with_dedup"))
    )
    return split_counts(views, "dataset_view")


def preview(spark: SparkSession, sf: str) -> DataFrame:
    return parse_preview(labelled_documents(spark, sf))


# --- features ---------------------------------------------------------------


def tokens(spark: SparkSession, sf: str) -> DataFrame:
    documents = read_table(spark, sf, "documents").select("doc_id", "text")
    cleaned = clean.clean_text(spread(documents, "doc_id"))
    found = cleaned.withColumn("tokens", word_tokens(F.col("clean")))
    return found.select(
        "doc_id", F.size("tokens").alias("n"), F.array_join("tokens", " ").alias("tokens")
    )


def stop_word_removal(spark: SparkSession, sf: str) -> DataFrame:
    documents = read_table(spark, sf, "documents").select("doc_id", "text")
    cleaned = clean.clean_text(spread(documents, "doc_id"))
    found = cleaned.withColumn("tokens", word_tokens(F.col("clean")))
    kept = without_stop_words(F.col("tokens"), ENGLISH_STOP_WORDS)
    return found.select("doc_id", F.array_join(kept, " ").alias("kept"))


def stop_word_table(spark: SparkSession, sf: str) -> DataFrame:
    """The stop words of a list written from the names of nations, and the English ones."""
    path = scratch_path(spark, "stop-words")
    names = read_table(spark, sf, "nation").select(F.lower("n_name").alias("value"))
    lines = names.select(F.concat(F.lit("  "), "value", F.lit("\t")).alias("value"))
    remarks = spark.createDataFrame([("# names",), ("",), ("   ",), ("\ufeffthe",)], "value string")
    lines.unionByName(remarks).write.text(path)
    listed = set(read_stop_words(spark, path))
    every = stop_words(spark, path)
    rows = [(w, w in ENGLISH_STOP_WORDS, w in listed) for w in every]
    return spark.createDataFrame(rows, "token string, english boolean, listed boolean")


def term_lists(config: FeatureConfig) -> Query:
    """Each mail's terms: how many, how many different ones, and a digest of them all."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        docs = term_documents(labelled_documents(spark, sf), config)
        ordered = F.array_join(F.array_sort("terms"), "|")
        return docs.select(
            "id",
            F.size("terms").alias("n"),
            F.size(F.array_distinct("terms")).alias("n_distinct"),
            F.md5(ordered.cast("binary")).alias("terms_md5"),
        )

    return query


def train_terms(spark: SparkSession, sf: str, config: FeatureConfig) -> DataFrame:
    parts = train.split_mails(labelled_documents(spark, sf))
    return prepared_terms(parts.where(F.col("split") == "train"), config)


def kept_vocabulary(config: FeatureConfig) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return rounded(vocabulary(train_terms(spark, sf, config), config))

    return query


def tfidf_weights(spark: SparkSession, sf: str) -> DataFrame:
    docs = train_terms(spark, sf, WORD_1_2).select("id", "terms")
    weights = tfidf(docs.repartition("id"), vocabulary(docs, WORD_1_2), WORD_1_2)
    return rounded(weights)


def idf_ranking(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(idf_extremes(written(vocabulary(train_terms(spark, sf, WORD_1_2), WORD_1_2), "vocabulary")))


def feature_matrix_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Matrix size under the default word settings, changed ones, and characters."""
    settings = (
        WORD_1_2,
        WORD_1_2.with_changes(name="unigrams_with_stop_words", max_n=1, stop_words=()),
        CHAR_3_5,
    )
    parts = train.split_mails(labelled_documents(spark, sf)).where(F.col("split") == "train")
    rows = None
    for config in settings:
        docs = prepared_terms(parts, config)
        row = matrix_stats(docs, vocabulary(docs, config)).withColumn("config", F.lit(config.name))
        rows = row if rows is None else rows.unionByName(row)
    return rounded(rows)


# --- split ------------------------------------------------------------------


def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    return assign_parts(labelled_documents(spark, sf)).select("id", "label", "split")


def fold_assignment(spark: SparkSession, sf: str) -> DataFrame:
    parts = assign_parts(labelled_documents(spark, sf))
    return parts.where(F.col("split") == "train").select("id", "label", "fold")


def rows_per_split(spark: SparkSession, sf: str) -> DataFrame:
    return split_counts(assign_parts(labelled_documents(spark, sf)))


def rows_per_split_and_label(spark: SparkSession, sf: str) -> DataFrame:
    return split_label_counts(assign_parts(labelled_documents(spark, sf)))


def rows_per_label(spark: SparkSession, sf: str) -> DataFrame:
    return label_counts(labelled_documents(spark, sf))


def random_sample(spark: SparkSession, sf: str) -> DataFrame:
    mails = labelled_documents(spark, sf)
    return sample_mail(mails, "ham").unionByName(sample_mail(mails, "spam")).select(
        "id", "label_name", "text"
    )


# --- baselines and Naive Bayes ----------------------------------------------


def majority_baseline(spark: SparkSession, sf: str) -> DataFrame:
    parts = assign_parts(labelled_documents(spark, sf))
    train_rows, test_rows = (parts.where(F.col("split") == s) for s in ("train", "test"))
    return majority_predictions(train_rows, test_rows).select("id", "label", "prediction")


def keyword_baseline(spark: SparkSession, sf: str) -> DataFrame:
    return keyword_predictions(labelled_documents(spark, sf)).select("id", "label", "prediction")


def prepared_parts(
    spark: SparkSession, sf: str, config: FeatureConfig = WORD_1_2
) -> Blocks:
    return train.part_blocks(train.split_mails(labelled_documents(spark, sf)), config)


def fitted_nb(spark: SparkSession, sf: str, alpha: float = ALPHA) -> naive_bayes.NaiveBayes:
    return naive_bayes.fit(prepared_parts(spark, sf), WORD_1_2, (alpha,))


def test_scores(spark: SparkSession, sf: str, alpha: float = ALPHA) -> DataFrame:
    """Test mails scored by Naive Bayes."""
    model = fitted_nb(spark, sf, alpha)
    return naive_bayes.score(model, model.blocks.where(F.col("fold").isNull()))


def low_threshold_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Test scores with the class decided at a low threshold, so that every cell fills."""
    return threshold_predictions(written(test_scores(spark, sf), "scored"), LOW_THRESHOLD)


def nb_model(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(fitted_nb(spark, sf).model_table(ALPHA))


def nb_scores(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(test_scores(spark, sf).select("id", "label", "score", "prediction"))


def nb_grid(spark: SparkSession, sf: str, config: FeatureConfig = WORD_1_2) -> DataFrame:
    """All mails scored by the view that did not train on them, per smoothing value."""
    model = naive_bayes.fit(prepared_parts(spark, sf, config), config, NB_ALPHAS, 3)
    return naive_bayes.score(model, model.blocks)


def nb_fold_scores(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(naive_bayes.fold_scores(nb_grid(spark, sf)))


def nb_grid_search(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(naive_bayes.grid_scores(naive_bayes.fold_scores(nb_grid(spark, sf))))


def nb_experiments(spark: SparkSession, sf: str) -> DataFrame:
    parts = train.split_mails(labelled_documents(spark, sf))
    rows = train.run_experiments(parts, ("nb",))
    return rounded(rows).select(
        "experiment", "model", "best_params", "cv_best_f1", "f1_spam", "accuracy", "roc_auc",
        "tn", "fp", "fn", "tp",
    )


def metric_table(spark: SparkSession, sf: str) -> DataFrame:
    """Unrounded metric rows of both baselines and the tuned Naive Bayes."""
    parts = train.split_mails(labelled_documents(spark, sf))
    test = parts.where(F.col("split") == "test")
    terms = train.TermTables(parts)
    model = train.train_model("nb", parts, terms=terms)
    rows = train.baseline_rows(parts).unionByName(train.model_row(model, test, terms))
    return written(rows, "metric-rows")


def ranked_models(spark: SparkSession, sf: str) -> DataFrame:
    return leaderboard(metric_table(spark, sf))


def chosen_model(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(best_model(metric_table(spark, sf)).select("model", "f1_spam", "best_params"))


# --- evaluation -------------------------------------------------------------


def threshold_decisions(spark: SparkSession, sf: str) -> DataFrame:
    scored = low_threshold_scores(spark, sf)
    return scored.select("id", "label", "prediction")


def low_confidence_flags(spark: SparkSession, sf: str) -> DataFrame:
    scored = test_scores(spark, sf)
    return scored.select(
        "id",
        near_threshold(0.5).alias("near_default"),
        near_threshold(LOW_THRESHOLD).alias("near_low"),
    )


def confusion_counts(spark: SparkSession, sf: str) -> DataFrame:
    return confusion(keyword_predictions(labelled_documents(spark, sf)))


def confusion_view(spark: SparkSession, sf: str) -> DataFrame:
    return confusion_matrix(low_threshold_scores(spark, sf))


def rates_of(*names: str) -> Query:
    """Some of the rates, of the keyword baseline over all labelled documents."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        scored = keyword_predictions(labelled_documents(spark, sf))
        return rounded(add_rates(confusion(scored)).select(*names))

    return query


def area_under_roc(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(roc_auc(written(test_scores(spark, sf), "scored")))


def score_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return metric_row(low_threshold_scores(spark, sf), "nb_low_threshold")


def class_report(spark: SparkSession, sf: str) -> DataFrame:
    return classification_report(low_threshold_scores(spark, sf))


def scored_with_text(spark: SparkSession, sf: str) -> DataFrame:
    texts_of = labelled_documents(spark, sf).select("id", "text")
    return low_threshold_scores(spark, sf).join(texts_of, "id")


def errors(spark: SparkSession, sf: str) -> DataFrame:
    return error_analysis(scored_with_text(spark, sf))


def top_errors(spark: SparkSession, sf: str) -> DataFrame:
    return error_analysis(scored_with_text(spark, sf), 10)


def keyword_errors(spark: SparkSession, sf: str) -> DataFrame:
    return error_analysis(keyword_predictions(labelled_documents(spark, sf)))


# --- explanation and comparison ---------------------------------------------


def contributions(spark: SparkSession, sf: str) -> DataFrame:
    model = fitted_nb(spark, sf)
    test = model.blocks.where(F.col("fold").isNull())
    return rounded(token_contributions(test, model.model_table(ALPHA), WORD_1_2))


def global_top_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(top_tokens(fitted_nb(spark, sf).model_table(ALPHA)))


def compared_models(spark: SparkSession, sf: str) -> DataFrame:
    """Test mails under the keyword baseline and three Naive Bayes models."""
    parts = train.split_mails(labelled_documents(spark, sf))
    fitted = naive_bayes.fit(train.part_blocks(parts, WORD_1_2), WORD_1_2, NB_ALPHAS)
    by_nb = naive_bayes.score(fitted, fitted.blocks.where(F.col("fold").isNull()))
    by_nb = by_nb.select(
        "id",
        "label",
        F.concat(F.lit("nb "), F.col("alpha").cast("string")).alias("model"),
        F.array_position(F.array(*map(F.lit, NB_ALPHAS)), F.col("alpha")).cast("int").alias("model_order"),
        "prediction",
        "score",
        F.lit("Spam probability").alias("score_type"),
    )
    by_keyword = keyword_predictions(parts.where(F.col("split") == "test")).select(
        "id",
        "label",
        F.lit("keyword").alias("model"),
        F.lit(0).alias("model_order"),
        "prediction",
        F.lit(None).cast("double").alias("score"),
        F.lit("none").alias("score_type"),
    )
    scored = written(by_keyword.unionByName(by_nb), "compared")
    return model_comparison(scored, rounded(metric_rows(scored)), "nb 0.1", LOW_THRESHOLD)


def comparison(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(compared_models(spark, sf))


def votes(spark: SparkSession, sf: str) -> DataFrame:
    return vote_summary(compared_models(spark, sf))


def leader(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(leader_summary(ranked_models(spark, sf), "nb"))


def readable_leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(leaderboard_display(ranked_models(spark, sf))).select(
        "model", "model_label", "precision_pct", "recall_pct", "f1_pct", "accuracy_pct"
    )


def leaderboard_rows(spark: SparkSession, sf: str) -> DataFrame:
    board = ranked_models(spark, sf)
    found = [("best", best_row(board)), ("keyword", row_of(board, "keyword")), ("unknown", row_of(board, "none"))]
    rows = None
    for wanted, row in found:
        row = row.select(F.lit(wanted).alias("wanted"), "model", "f1_spam", "accuracy")
        rows = row if rows is None else rows.unionByName(row)
    return rows


# --- streams ----------------------------------------------------------------


def streamed(spark: SparkSession, sf: str, score) -> DataFrame:
    table = read_table(spark, sf, "documents")

    def mails(rows: DataFrame) -> DataFrame:
        return rows.select(F.sha1(F.col("doc_id").cast("string").cast("binary")).alias("id"), "text")

    out = scratch_path(spark, "stream")
    stream = mails(table_stream(spark, sf, "documents", table.schema))
    score_stream(stream, score, f"{out}/scored", f"{out}/progress").awaitTermination()
    return scored_rows(spark, f"{out}/scored", mails(table), score)


def streamed_keyword_scores(spark: SparkSession, sf: str) -> DataFrame:
    return streamed(spark, sf, keyword_predictions).select("id", "prediction", "predicted_name")


def streamed_nb_scores(spark: SparkSession, sf: str) -> DataFrame:
    parts = train.split_mails(labelled_documents(spark, sf))
    return rounded(streamed(spark, sf, fixed_nb(parts)).select("id", "score", "prediction"))


def fixed_nb(parts: DataFrame) -> MailModel:
    """Naive Bayes fitted at one smoothing value, without a search."""
    blocks = train.part_blocks(parts.where(F.col("split") == "train"), WORD_1_2)
    return train.naive_bayes_model(naive_bayes.fit(blocks, WORD_1_2, (ALPHA,)), ALPHA)


def streamed_mail_files(spark: SparkSession, sf: str) -> DataFrame:
    """Mail files below two folders, picked up as a stream and scored by keywords."""

    def score(mails: DataFrame) -> DataFrame:
        return keyword_predictions(mails.withColumn("text_md5", digest("text")))

    base, out = mail_folders(spark, sf), scratch_path(spark, "stream")
    stream = mail_file_stream(spark, base)
    score_stream(stream, score, f"{out}/scored", f"{out}/progress").awaitTermination()
    none = spark.createDataFrame([], "id string, path string, text string")
    found = scored_rows(spark, f"{out}/scored", none, score)
    return found.select("text_md5", "prediction", "predicted_name")


# --- searched models ----------------------------------------------------------


def facts_of_scores(model: MailModel, scored: DataFrame, **more: bool) -> DataFrame:
    """Per test mail: whether its score is in range and agrees with the prediction, and
    whether the metric row follows from the predictions; ``more`` adds facts of the model.
    """
    score, is_spam = F.col("score"), F.col("prediction") == 1
    if model.score_type == DECISION:
        in_range, agrees = ~F.isnan(score) & (F.abs(score) < 1e9), is_spam == (score > 0)
    else:
        in_range, agrees = score.between(0, 1), is_spam == (score > 0.5)
    row = train.row_of_scores(model, scored).first()
    tp, wrong, right, n = scored.agg(
        F.count_if((F.col("label") == 1) & is_spam),
        F.count_if(F.col("label") != F.col("prediction")),
        F.count_if(F.col("label") == F.col("prediction")),
        F.count(F.lit(1)),
    ).first()
    f1 = 2 * tp / (2 * tp + wrong) if tp else 0.0
    follows = abs(row["f1_spam"] - f1) < 1e-9 and abs(row["accuracy"] - right / n) < 1e-9
    facts = {"metrics_follow": follows, **more}
    return scored.select(
        "id",
        "label",
        F.coalesce(in_range, F.lit(False)).alias("in_range"),
        F.coalesce(agrees, F.lit(False)).alias("agrees"),
        *(F.lit(bool(v)).alias(k) for k, v in facts.items()),
    )


def searched(name: str) -> Query:
    """A linear model after the search of its whole grid."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        parts = train.split_mails(labelled_documents(spark, sf))
        terms = train.TermTables(parts)
        model = train.train_model(name, parts, terms=terms)
        in_grid = {k: v for k, v in model.params.items() if k != "experiment"} in GRIDS[name]
        scored = train.score_test(model, parts.where(F.col("split") == "test"), terms)
        return facts_of_scores(model, scored, chosen_from_grid=in_grid, **least_loss(model, terms))

    return query


#: How far from zero the mean gradient of a fitted linear model may be.
GRADIENT = 1e-3


def least_loss(model: MailModel, terms: train.TermTables) -> dict[str, bool]:
    """Whether the gradient of a linear model's objective is zero where it was fitted."""
    blocks = terms.blocks(model.config).train()
    point = linear_point(model.name, {k: v for k, v in model.params.items() if k != "experiment"})
    if model.score_type == DECISION:
        sign = 2 * F.col("label") - 1
        slope = -2 * sign * F.greatest(F.lit(0.0), 1 - sign * F.col("score"))
    else:
        slope = F.col("score") - F.col("label")
    residual = written(model.score_blocks(blocks).select("id", slope.alias("r")), "residuals")
    n, total = residual.agg(F.count("*"), F.sum("r")).first()
    sums = term_products(blocks, model.table, residual, "r", model.config)
    gradient = F.abs(F.col("r") + F.col("weight") / point.cost) / n
    steepest = sums.join(model.table, "token").agg(F.max(gradient)).first()[0]
    by_intercept = total + model.intercept / point.intercept_scale**2 / point.cost
    return {
        "residuals_cancel": abs(by_intercept) / n < GRADIENT,
        "gradient_vanishes": steepest < GRADIENT,
        "gap_closed": model.gap <= TOLERANCE,
    }


def fitted(name: str, params: dict) -> Query:
    """A tree model fitted at one point of its grid, with facts that a constant would fail."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        parts = train.split_mails(labelled_documents(spark, sf))
        terms = train.TermTables(parts)
        model = train.fit_model(name, parts, params, terms=terms)
        facts = {"point_of_grid": params in GRIDS[name]}
        if name == "rf":
            facts["beats_constant"] = beats_constant(model, terms)
        else:
            # A round that finds no split leaves the loss where it was, to the last digit.
            facts["loss_falls"] = all(b <= a + 1e-9 for a, b in zip(model.losses, model.losses[1:]))
            facts["loss_is_halved"] = model.losses[-1] < model.losses[0] / 2
        scored = train.score_test(model, parts.where(F.col("split") == "test"), terms)
        return facts_of_scores(model, scored, **facts)

    return query


def beats_constant(model: MailModel, terms: train.TermTables) -> bool:
    """Whether the squared error over the train mails is well below that of their mean label."""
    off = F.col("score") - F.col("label")
    error, share = model.score_blocks(terms.blocks(model.config).train()).agg(F.avg(off * off), F.avg("label")).first()
    return error < 0.9 * share * (1 - share)


def forest_first_split(spark: SparkSession, sf: str) -> DataFrame:
    """The first split of a tree that draws nothing: of all mails and all terms the best."""
    data = train.binned_train(prepared_parts(spark, sf), WORD_1_2, None)
    growth = forest.Growth((forest.Run(naive_bayes.FINAL, None, 1.0),), 1, depth=1, bootstrap=False)
    root = forest.grow(data.vectors, growth).nodes.where(F.col("node") == ROOT)
    return rounded(root.select("mails", F.col("value").alias("spam_share"), "gain"))


def boosting_first_split(spark: SparkSession, sf: str) -> DataFrame:
    """The first split of boosted trees that draw nothing, and the loss before it."""
    data = train.binned_train(prepared_parts(spark, sf), WORD_1_2, None)
    run = boosting.Run(naive_bayes.FINAL, None, 1, 0.3)
    boosted = boosting.boost(data.vectors, (run,), 1)
    row = [(boosted.gains[0][0], boosted.losses[0][0], boosted.losses[0][1] < boosted.losses[0][0])]
    return rounded(spark.createDataFrame(row, "gain double, first_loss double, loss_falls boolean"))


def nb_config_choice(spark: SparkSession, sf: str) -> DataFrame:
    """The feature configuration and smoothing value that Naive Bayes picks."""
    parts = train.split_mails(labelled_documents(spark, sf))
    model = train.train_model("nb", parts, EXPERIMENTS)
    row = [(model.config.name, model.params["clf__alpha"], model.cv_f1)]
    return rounded(spark.createDataFrame(row, "experiment string, alpha double, cv_best_f1 double"))


def reloaded_model(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of a Naive Bayes model that was saved and loaded again."""
    parts = train.split_mails(labelled_documents(spark, sf))
    path = scratch_path(spark, "saved-model")
    save_model(fixed_nb(parts), path)
    test = parts.where(F.col("split") == "test").select("id", "label", "text")
    scored = load_model(spark, path).score(test)
    return rounded(scored.select("id", "label", "score", "prediction"))


def experiment_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Both models under both configurations, with their whole grids.

    Figures of Naive Bayes, and for both models whether the rates follow from the counts.
    """
    parts = train.split_mails(labelled_documents(spark, sf))
    rows = train.run_experiments(parts, ("nb", "svm"))
    of_nb = F.col("model") == "nb"
    n = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    f1 = F.coalesce(F.try_divide(2.0 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), F.lit(0.0))
    return rounded(rows).select(
        "experiment",
        "model",
        n.alias("mails"),
        (F.abs(F.col("f1_spam") - f1) < 1e-5).alias("f1_follows"),
        (F.abs(F.col("accuracy") - (F.col("tn") + F.col("tp")) / n) < 1e-5).alias("accuracy_follows"),
        F.col("cv_best_f1").between(0, 1).alias("cv_in_range"),
        F.when(of_nb, F.col("f1_spam")).alias("nb_f1_spam"),
        F.when(of_nb, F.col("cv_best_f1")).alias("nb_cv_best_f1"),
    )


FOREST_POINT = {
    "clf__n_estimators": 100,
    "clf__max_depth": 10,
    "clf__min_samples_split": 2,
    "clf__max_features": "sqrt",
}
BOOST_POINT = {
    "clf__n_estimators": 100,
    "clf__max_depth": 3,
    "clf__learning_rate": 0.3,
    "clf__subsample": 1.0,
    "clf__colsample_bytree": 0.8,
}

QUERIES: dict[str, Query] = {
    # sources and sinks
    "record_ids": record_ids,
    "limited_load": limited_load,
    "folder_load": folder_load,
    "delimited_file_load": delimited_file_load,
    "null_drop_and_cast": labelled_rows,
    "saved_split_tables": saved_split_tables,
    "reloaded_model": reloaded_model,
    # parse
    "parsed_mail_bytes": parsed_mail_bytes,
    "parsed_html_mails": parsed_html_mails,
    "composed_texts": composed_texts,
    "decoded_bytes": decoded_bytes,
    "html_to_text": page_texts,
    # clean
    "clean_nfkc": nfkc_texts,
    "clean_newlines": cleaning_step(clean.NEWLINES),
    "clean_header_lines": cleaning_step(clean.HEADER_LINES),
    "clean_lower_case": cleaning_step(F.lower),
    "clean_urls": cleaning_step(clean.URLS),
    "clean_addresses": cleaning_step(clean.ADDRESSES),
    "clean_money": cleaning_step(clean.MONEY),
    "clean_numbers": cleaning_step(clean.NUMBERS),
    "clean_base64_runs": cleaning_step(clean.BASE64_RUNS),
    "clean_tags": cleaning_step(clean.TAGS),
    "clean_punctuation": cleaning_step(clean.PUNCTUATION),
    "clean_spaces": cleaning_step(lambda t: F.trim(clean.collapse_spaces(t))),
    "clean_text": cleaned_texts,
    "clean_conversations": cleaned_conversations,
    "content_dedup": content_dedup,
    "dataset_views": dataset_views,
    "parse_preview": preview,
    # features
    "word_tokens": tokens,
    "stop_word_removal": stop_word_removal,
    "stop_word_table": stop_word_table,
    "word_ngrams": term_lists(WORD_1_2),
    "char_ngrams": term_lists(CHAR_3_5),
    "word_vocabulary": kept_vocabulary(WORD_1_2),
    "char_vocabulary": kept_vocabulary(CHAR_3_5),
    "tfidf_weights": tfidf_weights,
    "idf_ranking": idf_ranking,
    "feature_matrix_stats": feature_matrix_stats,
    # split
    "stratified_split": stratified_split,
    "fold_assignment": fold_assignment,
    "split_counts": rows_per_split,
    "split_label_counts": rows_per_split_and_label,
    "label_counts": rows_per_label,
    "random_sample": random_sample,
    # baselines, Naive Bayes, ranking
    "majority_baseline": majority_baseline,
    "keyword_baseline": keyword_baseline,
    "nb_model": nb_model,
    "nb_fold_scores": nb_fold_scores,
    "nb_grid_search": nb_grid_search,
    "nb_experiments": nb_experiments,
    "leaderboard": ranked_models,
    "best_model": chosen_model,
    # evaluation
    "nb_scores": nb_scores,
    "threshold_decisions": threshold_decisions,
    "low_confidence_flags": low_confidence_flags,
    "confusion_counts": confusion_counts,
    "confusion_matrix": confusion_view,
    "class_precision_recall": rates_of(
        "precision_ham", "recall_ham", "f1_ham", "support_ham",
        "precision_spam", "recall_spam", "f1_spam", "support_spam",
    ),
    "accuracies": rates_of("accuracy", "balanced_accuracy"),
    "error_rates": rates_of("specificity", "npv", "false_positive_rate", "false_negative_rate"),
    "averaged_f1": rates_of("macro_f1", "weighted_f1"),
    "roc_auc": area_under_roc,
    "metric_row": score_metrics,
    "classification_report": class_report,
    "error_analysis": errors,
    "keyword_errors": keyword_errors,
    "top_errors": top_errors,
    # explanation and comparison
    "token_contributions": contributions,
    "top_tokens": global_top_tokens,
    "model_comparison": comparison,
    "vote_summary": votes,
    "leader_summary": leader,
    "leaderboard_display": readable_leaderboard,
    "leaderboard_rows": leaderboard_rows,
    # streams
    "streamed_keyword_scores": streamed_keyword_scores,
    "streamed_nb_scores": streamed_nb_scores,
    "streamed_mail_files": streamed_mail_files,
    # searched models
    "logistic_regression": searched("lr"),
    "linear_svm": searched("svm"),
    "random_forest": fitted("rf", FOREST_POINT),
    "gradient_boosted_trees": fitted("xgb", BOOST_POINT),
    "forest_first_split": forest_first_split,
    "boosting_first_split": boosting_first_split,
    "experiment_grid": experiment_grid,
    "nb_config_choice": nb_config_choice,
}
