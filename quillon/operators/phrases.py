"""Names of several tokens: phrases found leftmost and longest in the token arrays.

A phrase is cut into tokens like any text and looked up by its first token, so each token of
the corpus is looked up once, whatever the number of phrases; the rest is compared only
where the first agrees. Of the hits of a sentence those are taken that start first, then
the longest, then the first past it. Phrases that every task can keep are looked up in Arrow
batches, and nothing is shuffled. Beyond that they are joined: hits are shuffled, and the
sentences if the hits are too many to be broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions.text import token_array
from quillon.operators.joins import can_be_held, list_of, lookup_join
from quillon.session import ship_package, stored

# A name that no caller's column has.
_SPANS = "__quillon_spans"
# Fixed value: the tag of the tokens of a name.
NAME_TAG = "NNP"


def phrase_tokens(phrases: DataFrame) -> DataFrame:
    """``first, words, nec`` of ``phrases(phrase, nec)``; the least class where several are given."""
    cut = phrases.where("nec is not null").select(
        token_array(F.coalesce("phrase", F.lit(""))).alias("words"), "nec"
    )
    return (
        cut.where(F.size("words") > 0)
        .groupBy("words")
        .agg(F.min("nec").alias("nec"))
        .select(F.get("words", F.lit(0)).alias("first"), "words", "nec")
    )


def _held_spans(spark: SparkSession, known: DataFrame) -> Column:
    """``array<struct<start, size, nec>>`` of the phrases in ``toks``, null where there are none."""
    ship_package(spark)
    table: dict[str, list] = {}
    for row in known.collect():
        table.setdefault(row["first"], []).append((len(row["words"]), row["words"], row["nec"]))
    for found in table.values():
        found.sort(key=lambda p: -p[0])
    shared = spark.sparkContext.broadcast(table)

    @F.arrow_udf("array<struct<start:int,size:int,nec:string>>")
    def spans(toks: pa.Array) -> pa.Array:
        flat = toks.flatten().dictionary_encode()
        words, codes = flat.dictionary.to_pylist(), flat.indices.to_numpy()
        listed = [shared.value.get(w) for w in words]
        places = np.nonzero(np.array([p is not None for p in listed], dtype=bool)[codes])[0]
        sizes = toks.value_lengths().fill_null(0).to_numpy()
        ends = np.cumsum(sizes)
        rows = np.searchsorted(ends, places, side="right")
        taken, past = [], 0
        for place, row in zip(places.tolist(), rows.tolist(), strict=True):
            if place < past:
                continue
            end = ends[row]
            for size, phrase, nec in listed[codes[place]]:
                if place + size <= end and all(
                    words[codes[place + i]] == phrase[i] for i in range(1, size)
                ):
                    taken.append((row, place - (end - sizes[row]), size, nec))
                    past = place + size
                    break
        row, start, size, nec = zip(*taken, strict=True) if taken else ((), (), (), ())
        cells = pa.StructArray.from_arrays(
            [pa.array(start, pa.int32()), pa.array(size, pa.int32()), pa.array(nec, pa.string())],
            ["start", "size", "nec"],
        )
        counts = np.bincount(np.array(row, dtype=np.int64), minlength=len(toks))
        return list_of(counts, cells)

    return spans(F.col("toks"))


def phrase_spans(annotated: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, spans``: ``array<struct<start, size, nec>>`` of the phrases of a sentence."""
    firsts = annotated.select(*keys, "toks", F.posexplode("toks").alias("start", "first"))
    hits = (
        lookup_join(firsts, known, ["first"], "inner", [*map(F.col, keys), F.col("start")])
        .withColumn("size", F.size("words"))
        .where(F.slice("toks", F.col("start") + 1, F.col("size")) == F.col("words"))
    )
    # The longest of those that start together.
    longest = hits.groupBy(*keys, "start").agg(
        F.max_by(F.struct("size", "nec"), F.col("size")).alias("best")
    )
    ordered = longest.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("start", "best.size", "best.nec"))).alias("hits")
    )
    chosen = F.expr(
        """aggregate(hits, cast(array() as array<struct<start:int,size:int,nec:string>>),
           (taken, h) -> if(h.start >= coalesce(get(taken, size(taken) - 1).start
             + get(taken, size(taken) - 1).size, 0), concat(taken, array(h)), taken))"""
    )
    return ordered.select(*keys, chosen.alias("spans"))


def with_phrases(annotated: DataFrame, phrases: DataFrame, keys: list[str]) -> DataFrame:
    """``annotated`` with entity class and tag of the phrases' tokens.

    ``phrases(phrase, nec)``; ``keys`` name a row of ``annotated``.
    """
    known = stored(phrase_tokens(phrases), "phrases")
    if can_be_held(known):
        joined = annotated.withColumn(_SPANS, _held_spans(annotated.sparkSession, known))
    else:
        spans = stored(phrase_spans(annotated, known, keys), "spans").withColumnRenamed("spans", _SPANS)
        joined = lookup_join(annotated, spans, keys, "left")

    def within(value: str, own: str) -> str:
        inside = f"filter({_SPANS}, s -> i >= s.start and i < s.start + s.size)"
        return f"transform({own}, (x, i) -> coalesce(get({inside}, 0){value}, x))"

    name = f"if({_SPANS} is null, {{own}}, {{new}})"
    ents = name.format(own="ents", new=within(".nec", "ents"))
    tagged = (
        f"transform(tags, (x, i) -> if(exists({_SPANS}, s -> i >= s.start and i < s.start + s.size),"
        f" '{NAME_TAG}', x))"
    )
    tags = name.format(own="tags", new=tagged)
    return joined.withColumn("ents", F.expr(ents)).withColumn("tags", F.expr(tags)).select(annotated.columns)
