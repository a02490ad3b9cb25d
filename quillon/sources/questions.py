"""Built-in sample questions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Eight sample questions in the style of a programming textbook.
SAMPLE_QUESTIONS = (
    "Why does a recursive function need a base case?",
    "What is a dictionary in a program?",
    "Who designed the first compiler?",
    "When was the language released?",
    "Where are local variables stored?",
    "How do loops end?",
    "Is a tuple a kind of list?",
    "Can two variables name the same object?",
)


def sample_questions(spark: SparkSession) -> DataFrame:
    """``q_id, text`` of the sample questions."""
    return spark.createDataFrame(list(enumerate(SAMPLE_QUESTIONS)), "q_id bigint, text string")
