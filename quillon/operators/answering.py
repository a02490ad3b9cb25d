"""From ranked sentences to answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.functions.answers import found_answer, quality_of, question_type, rendered_answer

# Fixed value: what stands between two answers in a digest.
DIGEST_SEPARATOR = "\n---------------------------------\n"

ANSWER_COLUMNS = ["q_id", "rank", "doc_id", "sent_no", "score", "answer", "quality"]


def question_types(questions: DataFrame) -> DataFrame:
    """``q_id, type`` of annotated questions."""
    return questions.select("q_id", question_type(F.col("lemmas"), F.col("tags")).alias("type"))


def extract_answers(candidates: DataFrame, legacy_span: bool = False) -> DataFrame:
    """Ranked sentences with ``type`` and token arrays -> ``ANSWER_COLUMNS``.

    The whole sentence, at quality 0, where no span is found.
    """
    found = found_answer(
        F.col("type"), F.col("toks"), F.col("lemmas"), F.col("tags"), F.col("ents"), legacy_span
    )
    return (
        candidates.withColumn("found", found)
        .withColumn("answer", F.coalesce("found", "sent"))
        .withColumn("quality", quality_of(F.col("found")))
        .select(*ANSWER_COLUMNS)
    )


def answer_report(questions: DataFrame, answers: DataFrame) -> DataFrame:
    """``q_id, line_no, line``: the question, then one ``(quality) answer`` per rank."""
    head = questions.select("q_id", F.lit(0).alias("line_no"), F.col("text").alias("line"))
    lines = answers.select(
        "q_id",
        F.col("rank").alias("line_no"),
        rendered_answer(F.col("quality"), F.col("answer")).alias("line"),
    )
    return head.unionByName(lines)


def answer_digest(questions: DataFrame, answers: DataFrame) -> DataFrame:
    """``q_id, digest``: a question's answers in rank order as one text, '' if none.

    A group holds at most the ``k`` answers of one question.
    """
    joined = answers.groupBy("q_id").agg(
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.struct("rank", "answer"))), lambda a: a["answer"]
            ),
            DIGEST_SEPARATOR,
        ).alias("digest")
    )
    return (
        questions.select("q_id")
        .join(joined, "q_id", "left")
        .select("q_id", F.coalesce("digest", F.lit("")).alias("digest"))
    )


def best_answer(answers: DataFrame) -> DataFrame:
    """``q_id, answer, quality``: the answer of highest quality, the later on a tie."""
    best = F.max_by(F.struct("answer", "quality"), F.struct("quality", "rank"))
    return answers.groupBy("q_id").agg(best.alias("b")).select("q_id", "b.answer", "b.quality")
