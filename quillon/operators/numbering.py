"""Consecutive numbers and ranks without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.operators.segment import explode_lemmas
from quillon.session import stored

# Names that no caller's column has.
_PLACE, _PART, _OFFSET = "__quillon_place", "__quillon_part", "__quillon_offset"
_LOCAL_BITS = 33  # monotonically_increasing_id keeps the partition number above these


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add ``name`` = 0, 1, 2, ... in the order of ``order`` (which must be total).

    Rows are range-partitioned and sorted in parallel; each partition then adds the
    number of rows before it. The sorted rows are written with their partition and
    place, so the borders cannot move between counting and numbering. Only the per-partition
    counts (one row per partition) meet in one task or are broadcast.
    """
    ordered = stored(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(_PLACE, F.monotonically_increasing_id()),
        "ordered",
    )
    part = F.shiftright(_PLACE, _LOCAL_BITS)
    counts = ordered.groupBy(part.alias(_PART)).agg(F.count("*").alias("n"))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PART, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(_OFFSET))
    local = F.col(_PLACE).bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return (
        ordered.withColumn(_PART, part)
        .join(F.broadcast(offsets), _PART)
        .withColumn(name, local + F.col(_OFFSET))
        .drop(_PART, _PLACE, _OFFSET)
    )


def top_per_group(df: DataFrame, group: list[str], order: list[Column], k: int, name: str):
    """The first ``k`` rows of each group with their 1-based rank in ``name``.

    The rank filter lets Spark cut every partition to ``k`` rows per group before
    the shuffle (``WindowGroupLimit``), so a group may be of any size.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= k)


def initial_index(sentences: DataFrame, page_size: int = 1000) -> DataFrame:
    """``initial, page, lemmas``: upper-case first letter -> its distinct lemmas, sorted.

    A letter's list is cut into pages of ``page_size`` lemmas so that no array grows
    with the corpus; a letter with fewer lemmas has the single page 0.
    """
    words = (
        explode_lemmas(sentences)
        .where(F.col("lemma").rlike(r"^\p{L}"))
        .distinct()
        .withColumn("initial", F.substring(F.upper("lemma"), 1, 1))
    )
    placed = numbered(words, [F.col("initial"), F.col("lemma")], "id")
    first = placed.groupBy("initial").agg(F.min("id").alias("first"))
    return (
        placed.join(first, "initial")
        .withColumn("page", F.floor((F.col("id") - F.col("first")) / page_size))
        .groupBy("initial", "page")
        .agg(F.sort_array(F.collect_list("lemma")).alias("lemmas"))
    )
