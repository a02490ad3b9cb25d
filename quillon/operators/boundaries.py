"""Sentence ends learned from the text: abbreviations, initials and numbers do not end one.

How a word goes with a period is counted over the corpus: ``dot`` times with one, ``plain``
times without. A word that has one nearly always is an abbreviation, more likely so when it
is short or has periods within ("e.g."), less when it is also seen without. The weight is
Dunning's log-likelihood ratio of two hypotheses (a period as often as behind any word, or
in 99 of 100 cases), times ``(periods within + 1) / (e ** letters * letters ** plain)``.

Words are counted in one pass and one shuffle; a table of distinct words is what is
weighed. The split itself is made inside the row, with the abbreviations as one broadcast
row: a closed class of words, if of any size then for being noise, so raise ``LEAST_DOTS``.

A period does not end a sentence before a letter or digit ("3.14", "e.g.", "example.com"),
behind an abbreviation ("Dr. Smith"), or behind a single capital ("J. Smith"). A line end
always does, as in the plain split.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions.arrays import bind

# The pieces of a text (all of it), and a word with what may stand around it.
PIECE_PATTERN = r"[^.!?\n]+[.!?]*\n*|[.!?]+\n*|\n+"
WORD_PATTERN = r"^[(\[\"']*(\p{L}(?:[\p{L}.]*\p{L})?)(\.?)[,;:)\]\"']*$"
# Least weight of an abbreviation, and how often it must have been seen with its period.
LEAST_WEIGHT, LEAST_DOTS = 0.3, 3
# How often an abbreviation has its period, by the second hypothesis.
ABBREVIATED = 0.99


def period_counts(documents: DataFrame) -> DataFrame:
    """``word, dot, plain``: lower-cased words with and without a period behind them."""
    tokens = F.explode(F.split(F.coalesce("text", F.lit("")), r"\s+")).alias("token")
    matched = documents.select(tokens).select(
        F.lower(F.regexp_extract("token", WORD_PATTERN, 1)).alias("word"),
        (F.regexp_extract("token", WORD_PATTERN, 2) == ".").alias("dotted"),
    )
    return matched.where("word <> ''").groupBy("word").agg(
        F.count(F.when(F.col("dotted"), 1)).alias("dot"),
        F.count(F.when(~F.col("dotted"), 1)).alias("plain"),
    )


def abbreviations(documents: DataFrame, least: float = LEAST_WEIGHT) -> DataFrame:
    """``word, dot, plain, weight`` of the words that a period belongs to, without it."""
    counts = period_counts(documents)
    totals = counts.agg(F.sum("dot").alias("dots"), F.sum(F.col("dot") + F.col("plain")).alias("words"))
    share = F.col("dots") / F.col("words")
    letters = F.length(F.replace("word", F.lit("."), F.lit("")))
    within = F.length("word") - letters
    chance = F.col("dot") * F.log(share) + F.col("plain") * F.log(1 - share)
    bound = F.col("dot") * math.log(ABBREVIATED) + F.col("plain") * math.log(1 - ABBREVIATED)
    form = (within + 1) / (F.exp(letters) * F.pow(letters, F.col("plain")))
    weighed = (
        counts.where(F.col("dot") >= LEAST_DOTS)
        .join(F.broadcast(totals))
        .where("dots < words")
        .withColumn("weight", -2 * (chance - bound) * form)
    )
    return weighed.where(F.col("weight") >= least).select("word", "dot", "plain", "weight")


def _merged(pieces: Column, joined: Callable[[Column, Column], Column]) -> Column:
    """Runs of pieces, where ``joined`` tells whether one goes on in the next."""

    def runs(all_pieces: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(all_pieces) - 1),
            lambda i: (i == 0) | ~joined(F.get(all_pieces, i - 1), F.get(all_pieces, i)),
        )
        return bind(
            starts,
            lambda s: F.transform(
                s,
                lambda p, j: F.array_join(
                    F.slice(all_pieces, p + 1, F.coalesce(F.get(s, j + 1), F.size(all_pieces)) - p), ""
                ),
            ),
        )

    return bind(pieces, lambda p: F.when(F.size(p) > 0, runs(p)).otherwise(p))


def learned_sentence_array(text: Column, known: Column) -> Column:
    """``array<struct<sent_no int, sent string>>``; ``known`` is an array of abbreviations.

    ``sent_no`` is the 0-based place among all sentences, before blank ones are dropped.
    """
    pieces = F.regexp_extract_all(text, F.lit(PIECE_PATTERN), F.lit(0))
    one_period = r"[^.!?\n]\.\z"  # a dollar sign would also match before a line end
    whole = _merged(
        pieces, lambda one, two: one.rlike(one_period) & two.rlike(r"^[\p{L}\p{N}]")
    )

    def goes_on(one: Column, two: Column) -> Column:
        last = F.regexp_extract(one, r"(\S+)\.\z", 1)
        word = F.lower(F.regexp_extract(last, WORD_PATTERN, 1))
        initial = last.rlike(r"^[(\[\"']*\p{Lu}$")
        return one.rlike(one_period) & (initial | F.array_contains(known, word))

    numbered = F.transform(
        _merged(whole, goes_on),
        lambda s, i: F.struct(
            i.cast("int").alias("sent_no"), F.regexp_replace(s, r"^\s+|\s+$", "").alias("sent")
        ),
    )
    return F.filter(numbered, lambda x: x["sent"] != "")


def with_abbreviations(documents: DataFrame, words: DataFrame, name: str) -> DataFrame:
    """``documents`` with the array of the abbreviations ``words(word)`` in each row."""
    row = words.agg(F.sort_array(F.collect_set("word")).alias(name))
    return documents.join(F.broadcast(row))
