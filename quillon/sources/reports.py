"""Text renderings: a view of documents, a report of topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions.tagging import entity_sql, lemma_sql, tag_sql
from quillon.functions.text import TOKEN_PATTERN, sentence_array


# A sentence and its tokens: (text, lemma, tag, entity) each, followed by a blank. The
# one-element transform computes the token array once for its four uses.
_SENTENCE_LINE = f"""concat('<', s.sent, '> ', transform(
    array(regexp_extract_all(s.sent, r"{TOKEN_PATTERN}", 0)),
    k -> array_join(transform(
        arrays_zip(k, {lemma_sql("k")}, {tag_sql("k")}, {entity_sql("k")}),
        c -> concat('(', c.k, ', ', c.`1`, ', ', c.`2`, ', ', c.`3`, ') ')), ''))[0], '\\n')"""


def document_view(documents: DataFrame, has_vector: Column | None = None) -> DataFrame:
    """``doc_id, view``: a line per sentence, ``<text>`` then its tokens.

    The prefix says whether TF-IDF is set. Rendered inside the row, without a shuffle.
    """
    flag = F.lit(False) if has_vector is None else has_vector
    prefix = F.when(flag, F.lit("{TF-IDF set} ")).otherwise(F.lit("{no TF-IDF} "))
    return (
        documents.withColumn("parts", sentence_array(F.coalesce("text", F.lit(""))))
        .withColumn("lines", F.expr(f"transform(parts, s -> {_SENTENCE_LINE})"))
        .select("doc_id", F.concat(prefix, F.array_join("lines", "")).alias("view"))
    )


def topic_lines(topic_words: DataFrame) -> DataFrame:
    """``topic, rank, line`` with lines ``TOPIC_i;term;weight``."""
    return topic_words.select(
        "topic",
        "rank",
        F.concat_ws(
            ";",
            F.concat(F.lit("TOPIC_"), F.col("topic").cast("string")),
            "term",
            F.col("weight").cast("string"),
        ).alias("line"),
    )


def write_topic_report(topic_words: DataFrame, path: str) -> None:
    """Write the lines as text, sorted by topic and rank across the files."""
    (
        topic_lines(topic_words)
        .repartitionByRange("topic", "rank")
        .sortWithinPartitions("topic", "rank")
        .select("line")
        .write.mode("overwrite")
        .text(path)
    )
