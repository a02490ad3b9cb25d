"""Mixing sources to target weights by iterative proportional fitting.

Documents are counted into cells of source, language and topic. The token weights of
the cells are raked to the three sets of marginal targets in turn, ``ROUNDS`` times,
each weight bounded by what its cell has to give. A cell's weight over its tokens is the
calibrated probability with which each of its documents is sampled, so the expected
tokens of a marginal are its target, as far as the bounds let it. The draw is a hash of
the id: the same document meets the same fate in every run.

Unless given, a target is the marginal's own tokens to the power ``TEMPER``, which lifts
small sources, languages and topics. The topic of a document is its kind of content,
read off the whole text: ``figures``, ``capitals``, or ``note``, ``article`` and ``long``
by its tokens (runs without ASCII white space).

Only the cells are raked, as DataFrames: sums combine before their shuffle, and each
round is written to the shared folder. Documents meet their cell's probability in a join
that is broadcast when the cells are measured small, else salted.

Cases: a null source or language counts as an empty name, a null text as empty. A
document without tokens is sampled with its cell's probability, 0 in a cell without
tokens. A null ``doc_id`` is drawn by its text. Rows repeated are each counted, and share
their fate. A value without a given target gets none (probability 0). An empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.operators.joins import lookup_join
from quillon.session import stored

ROUNDS, TEMPER, FRACTION = 10, 0.7, 0.6
DIMENSIONS = ("source", "lang", "topic")
WORD = "[^\\x20\\x09-\\x0D]+"
CELL = [f"__mix_{name}" for name in DIMENSIONS]


def _share(text: Column, characters: str) -> Column:
    left = F.length(F.translate(text, characters, ""))
    return (F.length(text) - left) / F.greatest(F.length(text), F.lit(1))


def described(documents: DataFrame) -> DataFrame:
    """``documents`` with the cell of each row, its tokens and its draw."""
    text = F.coalesce(F.col("text"), F.lit(""))
    tokens = F.regexp_count(text, F.lit(WORD)).cast("bigint")
    topic = (
        F.when(_share(text, "0123456789") > 0.05, "figures")
        .when(_share(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ") > 0.3, "capitals")
        .when(F.col("__mix_tokens") < 100, "note")
        .when(F.col("__mix_tokens") < 1000, "article")
        .otherwise("long")
    )
    name = F.coalesce(F.col("doc_id").cast("string"), text)
    digits = F.substring(F.md5(F.concat(F.lit("mix:"), name).cast("binary")), 1, 13)
    draw = F.conv(digits, 16, 10).cast("double") / F.lit(16.0**13)
    return (
        documents.withColumn("__mix_tokens", tokens)
        .withColumn("__mix_source", F.coalesce(F.col("source").cast("string"), F.lit("")))
        .withColumn("__mix_lang", F.coalesce(F.col("lang").cast("string"), F.lit("")))
        .withColumn("__mix_topic", topic)
        .withColumn("__mix_draw", draw)
    )


def _total(rows: DataFrame, value: str) -> float:
    return rows.agg(F.sum(value).cast("double")).first()[0] or 1.0


def _targets(cells: DataFrame, dimension: str, given: dict[str, float] | None) -> DataFrame:
    """The target share of each value of a dimension."""
    if given is None:
        marginal = cells.groupBy(dimension).agg(F.pow(F.sum("tokens").cast("double"), TEMPER).alias("x"))
    else:
        rows = [(str(name), float(share)) for name, share in given.items()]
        marginal = cells.sparkSession.createDataFrame(rows, f"{dimension} string, x double")
    total = F.lit(_total(marginal, "x"))
    return marginal.select(dimension, (F.col("x") / total).alias(f"{dimension}_target"))


def raked_cells(
    described_rows: DataFrame,
    targets: dict[str, dict[str, float]] | None = None,
    fraction: float = FRACTION,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Each cell with ``tokens``, its raked ``weight`` and ``probability``.

    ``targets`` maps ``source``, ``lang`` or ``topic`` to shares by value.
    """
    counted = described_rows.groupBy(*CELL).agg(F.sum("__mix_tokens").alias("tokens"))
    cells = stored(counted, "cells")
    share = F.col("tokens") / F.lit(_total(cells, "tokens"))
    raked = cells.select(*CELL, "tokens", share.alias("weight"), (share / fraction).alias("most"))
    for dimension, name in zip(CELL, DIMENSIONS, strict=True):
        target = _targets(cells, dimension, (targets or {}).get(name))
        raked = raked.join(target, dimension, "left")
    for _ in range(rounds):
        raked = stored(raked, "raked")
        for dimension in CELL:
            sums = raked.groupBy(dimension).agg(F.sum("weight").alias("sum"))
            factor = F.coalesce(F.col(f"{dimension}_target"), F.lit(0.0)) / F.col("sum")
            weight = F.when(F.col("sum") > 0, F.least(F.col("weight") * factor, F.col("most")))
            raked = raked.join(sums, dimension).withColumn("weight", F.coalesce(weight, F.lit(0.0)))
            raked = raked.drop("sum")
    chance = F.when(F.col("most") > 0, F.col("weight") / F.col("most")).otherwise(0.0)
    return stored(raked.select(*CELL, "tokens", "weight", chance.alias("probability")), "raked")


def _sampled(documents: DataFrame, **options) -> DataFrame:
    rows = described(documents)
    cells = raked_cells(described(documents.select("doc_id", "text", "source", "lang")), **options)
    chances = cells.select(
        *CELL, F.col("weight").alias("__mix_weight"), F.col("probability").alias("__mix_chance")
    )
    joined = lookup_join(rows, chances, CELL, "inner", [F.col("__mix_draw")])
    return joined.withColumn("__mix_kept", F.col("__mix_draw") < F.col("__mix_chance"))


def mixed(documents: DataFrame, **options) -> DataFrame:
    """Each document with its cell, ``probability`` and whether it is sampled (``kept``)."""
    return _sampled(documents.select("doc_id", "text", "source", "lang"), **options).select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("__mix_source").alias("source"),
        F.col("__mix_lang").alias("lang"),
        F.col("__mix_topic").alias("topic"),
        F.col("__mix_tokens").alias("n_tokens"),
        F.round("__mix_weight", 6).alias("cell_weight"),
        F.round("__mix_chance", 6).alias("probability"),
        F.col("__mix_kept").alias("kept"),
    )


def sample_to_targets(documents: DataFrame, **options) -> DataFrame:
    """The sampled rows of ``documents``, with all their columns."""
    return _sampled(documents, **options).where("__mix_kept").select(*documents.columns)
