"""Reading corpora, questions and word lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_corpus_folder(spark: SparkSession, folder: str) -> DataFrame:
    """One row per whole text file: ``doc_id, path, text``.

    ``doc_id`` is a hash of the path, so it needs no pass over the files.
    """
    return spark.read.text(folder, wholetext=True).select(
        F.xxhash64("_metadata.file_path").alias("doc_id"),
        F.col("_metadata.file_path").alias("path"),
        F.col("value").alias("text"),
    )


def read_question_file(spark: SparkSession, path: str) -> DataFrame:
    """One question per non-blank line: ``q_id, text``.

    Ids grow with the line order of a file but have gaps.
    """
    return (
        spark.read.text(path)
        .select(F.monotonically_increasing_id().alias("q_id"), F.trim("value").alias("text"))
        .where("text <> ''")
    )


def read_stop_words(spark: SparkSession, path: str) -> DataFrame:
    """One word per line: ``word``, trimmed and distinct."""
    return (
        spark.read.text(path).select(F.trim("value").alias("word")).where("word <> ''").distinct()
    )


def read_documents(spark: SparkSession, path: str, least_splits: int | None = None) -> DataFrame:
    """The ``documents`` table in the splits of its files.

    A table in fewer than ``least_splits`` splits, such as a single small file, is dealt out
    evenly, so that all cores have work; any other stays where it is.
    """
    documents = spark.read.parquet(path)
    if least_splits is None or documents.rdd.getNumPartitions() >= least_splits:
        return documents
    return documents.repartition(least_splits)
