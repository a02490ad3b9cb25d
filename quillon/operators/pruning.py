"""The best elements of each question without scoring all of them, exactly.

Most question-element pairs share nothing but very frequent terms. They are ruled out by
bounds per question, over *blocks* of postings: those of one feature whose count in the
element lies between two caps. What a posting can add to a score is known from its block.

1. *Probe.* The elements in the question's rarest blocks, some ``PROBE`` postings, are
   scored in full. Rare blocks are rare terms and bigrams, and frequent ones where they are
   repeated much. The ``k``-th best score found is a threshold: the ``k``-th best of all
   elements cannot be below it.
2. *Cuts.* Blocks are set aside, those first that hold many postings and can add little,
   as long as an element with nothing else stays below ``SHARE`` of the threshold: terms
   add up, shared bigrams multiply, and so does an equal topic. How much of the room goes
   to bigrams is settled per question by what saves most. An element whose postings are
   all set aside is out.
3. *Partial scores.* For the other elements the postings beyond the cuts are added up;
   with all that was set aside on top, many still cannot reach the threshold.
4. What is left, the *contenders*, is scored in full.

All steps work on ``matches`` where they lie after a shuffle by element; the question
side is broadcast, as in ``scoring.score``, and no bound ever drops a possible winner.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.operators import scoring
from quillon.operators.numbering import top_per_group
from quillon.operators.scoring import BIGRAM, BIGRAM_BOOST, FEATURE, IDF_UNITS, SIZE, TERM, TOPIC_BOOST
from quillon.operators.tfidf import idf_value
from quillon.session import stored

BLOCK = [*FEATURE, "cap"]
# Up to so many postings are added up at once sooner than bounds for them are made.
FEW_PAIRS = 20_000_000
# Postings per question that the threshold is taken from.
PROBE = 500
# Share of the threshold up to which blocks are set aside.
SHARE = 0.6
# Shared bigrams that the room may allow for; one of these is chosen per question.
ALLOWANCES = (0, 1, 2, 3, 5)
# Room for rounding in a logarithm of a score.
_MARGIN = 1e-9


def cap_of(n: Column) -> Column:
    """The block of a posting: its count up to 4, beyond that the next power of two."""
    power = F.pow(F.lit(2.0), F.ceil(F.log2(n.cast("double")))).cast("bigint")
    # A logarithm next to a whole number may be rounded to the wrong side of it.
    return F.when(n <= 4, n).when(power < n, power * 2).otherwise(power)


def posting_blocks(matches: DataFrame) -> DataFrame:
    """``kind, key, cap, postings``: how many postings each block has."""
    counted = matches.where(F.col("kind") != SIZE).groupBy(*FEATURE, cap_of(F.col("n")).alias("cap"))
    return counted.agg(F.count("*").alias("postings"))


def contenders(
    features: DataFrame,
    matches: DataFrame,
    weights: DataFrame,
    size: Column,
    keys: list[str],
    k: int,
    boost_possible: bool = False,
    probe: int = PROBE,
) -> DataFrame:
    """``q_id, keys, base, shared, boosted`` of all that can be among a question's ``k`` best.

    ``features`` must be small enough to be broadcast. With ``boost_possible`` a topic
    boost may still be added to the scores.
    """
    spark = features.sparkSession
    postings = matches.where(F.col("kind") != SIZE).withColumn("cap", cap_of(F.col("n")))
    idf = F.round(idf_value(size, F.col("df")) * IDF_UNITS).cast("bigint")
    asked = stored(
        features.join(F.broadcast(weights.select(*FEATURE, "df")), FEATURE).select(
            "q_id", *FEATURE, "nq", idf.alias("idf")
        ),
        "weighted",
    )
    blocks = stored(posting_blocks(matches), "blocks")
    questions = asked.select("q_id").distinct().count()
    tasks = scoring.scoring_tasks(spark, questions * probe)
    threshold = stored(_thresholds(asked, blocks, postings, keys, k, probe, tasks), "thresholds")
    cut = stored(_cuts(asked, blocks, threshold, boost_possible), "cuts")
    beyond = cut.agg(F.sum("left").alias("left")).first()["left"] or 0
    located = postings.repartition(scoring.scoring_tasks(spark, beyond), *keys)
    possible = _possible(cut, blocks, threshold, located, keys, boost_possible)
    return score_pairs(possible, located, asked, keys)


def _sums() -> list[Column]:
    """``base`` and ``shared`` over postings beside the question's side of them."""
    weight = F.col("n") * F.col("nq")
    term = F.when(F.col("kind") == TERM, weight * F.col("idf"))
    bigram = F.when(F.col("kind") == BIGRAM, weight)
    return [
        F.coalesce(F.sum(term), F.lit(0)).alias("base"),
        F.coalesce(F.sum(bigram), F.lit(0)).alias("shared"),
    ]


def _possible(
    cut: DataFrame,
    blocks: DataFrame,
    threshold: DataFrame,
    located: DataFrame,
    keys: list[str],
    boost_possible: bool,
) -> DataFrame:
    """``q_id, keys`` of the elements that can reach the threshold."""
    # Joined block by block, so that postings set aside are not even looked at.
    beyond = cut.join(F.broadcast(blocks.select(*BLOCK)), FEATURE).where("cap > cut")
    needed = F.broadcast(beyond.select("q_id", *BLOCK, "nq", "idf"))
    partial = located.join(needed, BLOCK).groupBy("q_id", *keys).agg(*_sums())
    # What the postings set aside can add at most.
    aside = cut.withColumn("n", F.col("cut")).groupBy("q_id").agg(*_sums())
    spare = aside.select(
        "q_id", F.col("base").alias("spare_base"), F.col("shared").alias("spare_shared")
    ).join(F.broadcast(threshold), "q_id", "left")
    boost = math.log(TOPIC_BOOST) if boost_possible else 0.0
    most = (
        F.log(F.col("base") + F.col("spare_base"))
        + (F.col("shared") + F.col("spare_shared")) * F.lit(math.log(BIGRAM_BOOST))
        + F.lit(boost + _MARGIN)
    )
    # A logarithm of 0 is null: without any term an element has no score.
    reaches = F.col("threshold").isNull() | (most >= F.col("threshold"))
    return partial.join(F.broadcast(spare), "q_id").where(reaches).select("q_id", *keys)


def score_pairs(pairs: DataFrame, located: DataFrame, asked: DataFrame, keys: list[str]) -> DataFrame:
    """Full scores of distinct ``q_id, keys``, which lie where ``located`` does."""
    side = F.broadcast(asked.select("q_id", *FEATURE, "nq", "idf"))
    carried = [c for c in ("topic",) if c in located.columns]
    found = pairs.join(located.hint("shuffle_hash"), keys).join(side, ["q_id", *FEATURE])
    summed = found.groupBy("q_id", *keys).agg(*_sums(), *[F.max(c).alias(c) for c in carried])
    return summed.where("base > 0").select(
        "q_id", *keys, "base", "shared", F.lit(0).alias("boosted"), *carried
    )


def _thresholds(
    asked: DataFrame,
    blocks: DataFrame,
    postings: DataFrame,
    keys: list[str],
    k: int,
    probe: int,
    tasks: int,
) -> DataFrame:
    """``q_id, threshold``: the rank value of the ``k``-th best element of the probe."""
    rarest = Window.partitionBy("q_id").orderBy("postings", "key", "kind", "cap")
    before = F.sum("postings").over(rarest.rowsBetween(Window.unboundedPreceding, -1))
    few = (F.col("before") == 0) | (F.col("before") + F.col("postings") <= probe)
    chosen = (
        asked.join(F.broadcast(blocks), FEATURE)
        .withColumn("before", F.coalesce(before, F.lit(0)))
        .where(few)
        .select("q_id", *BLOCK)
    )
    located = postings.repartition(tasks, *keys)
    pairs = located.join(F.broadcast(chosen), BLOCK).select("q_id", *keys).distinct()
    scored = score_pairs(pairs, located, asked, keys).withColumn("value", scoring.rank_value())
    best = top_per_group(scored.select("q_id", "value"), ["q_id"], [F.desc("value")], k, "rank")
    return best.where(F.col("rank") == k).select("q_id", F.col("value").alias("threshold"))


def _cuts(asked: DataFrame, blocks: DataFrame, threshold: DataFrame, boost_possible: bool) -> DataFrame:
    """``asked`` with ``cut``, up to which postings are set aside, and ``left``, those beyond.

    A question's share of the bound is spent on blocks in the order of postings per cost.
    """
    rising = Window.partitionBy(*FEATURE).orderBy("cap")
    stepped = blocks.withColumn("step", F.col("cap") - F.coalesce(F.lag("cap").over(rising), F.lit(0)))
    unit = F.when(F.col("kind") == TERM, F.col("idf")).otherwise(F.lit(1)).cast("double")
    spent = asked.join(F.broadcast(stepped), FEATURE).withColumn(
        "cost", F.col("step") * F.col("nq") * unit
    )
    options = F.explode(F.array(*[F.lit(a) for a in ALLOWANCES])).alias("allowance")
    boost = math.log(TOPIC_BOOST) if boost_possible else 0.0
    kept_back = F.col("allowance") * F.lit(math.log(BIGRAM_BOOST)) + F.lit(boost + _MARGIN)
    room = F.exp(F.col("threshold") + F.lit(math.log(SHARE)) - kept_back)
    budget = F.when(F.col("kind") == TERM, room).otherwise(F.col("allowance").cast("double"))
    priced = (
        spent.join(F.broadcast(threshold), "q_id", "left")
        .select("*", options)
        .withColumn("budget", F.coalesce(budget, F.lit(-1.0)))
    )
    # Blocks of terms without weight are free and come first.
    worth = F.col("postings") / F.greatest(F.col("cost"), F.lit(1e-9))
    cheapest = (
        Window.partitionBy("q_id", "allowance", "kind")
        .orderBy(F.desc(worth), "key", "cap")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    so_far = F.sum("cost").over(cheapest)
    is_term = F.col("kind") == TERM
    fits = F.when(is_term, so_far < F.col("budget")).otherwise(so_far <= F.col("budget"))
    # A feature is cut below its first block that is not set aside.
    lowest = priced.withColumn("fits", fits).groupBy("q_id", "allowance", *FEATURE).agg(
        F.coalesce(F.min(F.when(~F.col("fits"), F.col("cap"))), F.lit(2**62)).alias("kept"),
        F.collect_list(F.struct("cap", "postings")).alias("caps"),
    )
    below = F.filter("caps", lambda c: c["cap"] < F.col("kept"))
    beyond = F.filter("caps", lambda c: c["cap"] >= F.col("kept"))
    per_feature = lowest.select(
        "q_id",
        "allowance",
        *FEATURE,
        F.coalesce(F.array_max(below)["cap"], F.lit(0)).alias("cut"),
        F.aggregate(beyond, F.lit(0).cast("bigint"), lambda s, c: s + c["postings"]).alias("left"),
    )
    left = per_feature.groupBy("q_id", "allowance").agg(F.sum("left").alias("left"))
    best = left.groupBy("q_id").agg(
        F.min_by("allowance", F.struct("left", "allowance")).alias("allowance")
    )
    settled = per_feature.join(F.broadcast(best), ["q_id", "allowance"])
    return asked.join(settled.drop("allowance"), ["q_id", *FEATURE])
