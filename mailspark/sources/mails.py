"""Readers that give mail records: id, label, label_name, text, path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailspark.config import HAM, SPAM
from mailspark.functions.mail import compose_text, parse_mails
from mailspark.operators.dedup import drop_repeated_texts
from mailspark.sources.scratch import written

MAIL_COLUMNS = ("id", "label", "label_name", "text", "path")


def label_name(label: Column) -> Column:
    """The name of a label; null for anything else."""
    return F.when(label == SPAM, "spam").when(label == HAM, "ham")


def checked_label(label: Column) -> Column:
    """The label as 0 or 1; anything else, also a missing one, stops the job."""
    number = label.try_cast("int")
    shown = F.coalesce(label.cast("string"), F.lit("nothing"))
    wrong = F.raise_error(F.concat(F.lit("labels must be 0 or 1, found "), shown))
    return F.when(number.isin(HAM, SPAM), number).otherwise(wrong.cast("int"))


def as_mails(df: DataFrame) -> DataFrame:
    """Complete a frame with label, text and path to mail records; a subject is kept."""
    return df.select(
        F.sha1(F.col("path").cast("binary")).alias("id"),
        checked_label(F.col("label")).alias("label"),
        label_name(F.col("label").try_cast("int")).alias("label_name"),
        "text",
        "path",
        *(c for c in ("subject",) if c in df.columns),
    )


def file_tasks(spark: SparkSession) -> int:
    """Over how many tasks work on many small files is dealt.

    Left to sizes, all files are written by few tasks, for they are small, and read by one
    for every 32 of them, for Spark counts each as 4 MB.
    """
    return 4 * spark.sparkContext.defaultParallelism


def read_folder(spark: SparkSession, folder: str, label: int) -> DataFrame:
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", "content")
        .coalesce(file_tasks(spark))
    )
    return mails_of_files(files.withColumn("label", F.lit(label)))


def mails_of_files(files: DataFrame) -> DataFrame:
    """Mail records from ``path, content, label``; mails without any text are dropped."""
    return as_mails(
        parse_mails(files)
        .withColumn("text", compose_text(F.col("subject"), F.col("body")))
        .where(F.length("text") > 0)
    )


def read_folders(spark: SparkSession, base: str) -> DataFrame:
    """Every file below ``base/ham`` and ``base/spam``."""
    base = base.rstrip("/")
    ham = read_folder(spark, f"{base}/ham", HAM)
    return ham.unionByName(read_folder(spark, f"{base}/spam", SPAM))


def read_labelled_csv(spark: SparkSession, path: str) -> DataFrame:
    """``text`` and ``label`` of a delimited file; ``raw_text`` stands in for ``text``.

    Quoted line ends are kept, which makes one file one read task: hand a large
    corpus over as many files.
    """
    separator = "\t" if path.lower().endswith(".tsv") else ","
    frame = spark.read.csv(
        path, sep=separator, header=True, multiLine=True, quote='"', escape='"'
    )
    return labelled_frame(frame)


def labelled_frame(frame: DataFrame) -> DataFrame:
    """Pick and cast the text and label columns of any frame; null texts are dropped.

    A row with a text and without a label of 0 or 1 stops the job.
    """
    if "text" in frame.columns:
        text = "text"
    elif "raw_text" in frame.columns:
        text = "raw_text"
    else:
        raise ValueError("expected a text or raw_text column")
    if "label" not in frame.columns:
        raise ValueError("expected a label column")
    return frame.where(F.col(text).isNotNull()).select(
        F.col(text).cast("string").alias("text"), checked_label(F.col("label")).alias("label")
    )


def _is_folder_pair(spark: SparkSession, path: str) -> bool:
    """Whether both label folders exist; asks the file system and lists nothing below."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folders = [jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{n}") for n in ("ham", "spam")]
    return all(f.getFileSystem(conf).exists(f) for f in folders)


def first_mails(mails: DataFrame, limit: int | None) -> DataFrame:
    """The first ``limit`` mails, ham before spam, by path; no limit when None or 0."""
    if not limit:
        return mails
    order = [c for c in ("label", "path", "text") if c in mails.columns]
    return mails.orderBy(*order).limit(limit)


def load_mails(
    spark: SparkSession, path: str, dedup: bool = False, limit: int | None = None
) -> DataFrame:
    """Load a ham/spam folder pair or a labelled ``.csv``/``.tsv`` file.

    Rows of a delimited file carry no path, so they are numbered, copies too, and
    written once to keep their numbers.
    """
    if path.lower().endswith((".csv", ".tsv")):
        number = F.monotonically_increasing_id().cast("string")
        rows = read_labelled_csv(spark, path).withColumn(
            "path", F.concat(F.lit(f"{path}#"), number)
        )
        mails = written(as_mails(rows), "mails")
    elif _is_folder_pair(spark, path):
        mails = read_folders(spark, path)
    else:
        raise ValueError(f"unsupported data path: {path}")
    if dedup:
        mails = drop_repeated_texts(mails)
    return first_mails(mails, limit)
