"""Lemmas learned from a corpus: inflected words looked up among its own words.

A word in ``-ing``, ``-ed``, ``-er``, ``-est`` or ``-es`` may be its stem with an ending:
the word without it, with an ``e`` for it, or with a doubled consonant undone. A stem is
taken when the corpus has it as a word of its own, most often of those that it has. This
keeps "thing" and "red" whole, and tells "used" (use) from "stopped" (stop).

The table is a lexicon: ``surface, lemma`` with empty tags, one row per spelling, so it is
given to ``segment.annotate`` (and so to everything that takes a lexicon) as it is. Words
are counted before anything is joined; what is joined is one row per distinct word.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions.lexicon import CLOSED_WORDS
from quillon.operators.joins import lookup_join
from quillon.operators.segment import FIELDS
from quillon.session import stored

# The endings, longest first. Degrees ("-er") need a stem more frequent than
# the word itself, as nouns of their own end so too.
ENDINGS = ("ing", "est", "ed", "er", "es")
DEGREES = ("est", "er")
# Tags of words that may be a stem, and letters of which it needs one.
STEM_TAGS = ("NN", "VB")
VOWEL = "[aeiouy]|[^a-z]"
_WORD = r"^\p{L}+$"


def _tagged(annotated: DataFrame) -> DataFrame:
    """``tok, tag`` of every token."""
    cells = F.explode(F.arrays_zip(FIELDS["tok"], FIELDS["pos"])).alias("t")
    return annotated.select(cells).select(F.col("t.toks").alias("tok"), F.col("t.tags").alias("tag"))


def word_counts(annotated: DataFrame) -> DataFrame:
    """``tok, low, n, n_stem``: distinct words, and how often each stands where a stem may."""
    stem = F.when(F.col("tag").isin(*STEM_TAGS), 1).otherwise(0)
    low = F.lower("tok")
    words = _tagged(annotated).where(low.rlike(_WORD) & ~low.isin(CLOSED_WORDS))
    counts = words.groupBy("tok").agg(F.count("*").alias("n"), F.sum(stem).alias("n_stem"))
    return counts.select("tok", low.alias("low"), "n", "n_stem")


def _candidates(low: Column) -> Column:
    """``array<struct<place, stem, degree>>`` of the stems a word may have."""
    found = []
    for ending in ENDINGS:
        size = F.length(low) - len(ending)
        base = F.substring(low, F.lit(1), size)
        last, before = F.substring(base, size, F.lit(1)), F.substring(base, size - 1, F.lit(1))
        short = F.when(last == before, F.substring(base, F.lit(1), size - 1))
        stems = (base, F.concat(base, F.lit("e")), short)
        fits = F.endswith(low, F.lit(ending)) & (size >= 2)
        found += [
            F.when(
                fits & stem.isNotNull(),
                F.struct(F.lit(place).alias("place"), stem.alias("stem"), F.lit(ending in DEGREES).alias("degree")),
            )
            for place, stem in enumerate(stems)
        ]
    return F.filter(F.array(*found), lambda c: c.isNotNull())


def lemma_table(corpus: DataFrame, *others: DataFrame) -> DataFrame:
    """``surface, lemma, pos, nec, n_stem`` of the words whose stem the corpus has.

    ``corpus`` and ``others`` (annotated questions, say) are annotated; stems are looked for
    in the corpus only. ``pos`` and ``nec`` are null: the rules' own stand.
    """
    counts = stored(word_counts(corpus), "words")
    stems = counts.groupBy(F.col("low").alias("stem")).agg(F.sum("n_stem").alias("n_stem")).where("n_stem > 0")
    own = stems.select(F.col("stem").alias("low"), F.col("n_stem").alias("n_own"))
    words = reduce(
        DataFrame.unionByName, [counts.select("tok", "low"), *[word_counts(o).select("tok", "low") for o in others]]
    ).distinct()
    inflected = words.select("tok", "low", F.explode(_candidates(F.col("low"))).alias("c")).select(
        "tok", "low", "c.*"
    )
    inflected = inflected.where((F.length("stem") >= 2) & F.col("stem").rlike(VOWEL))
    known = lookup_join(inflected, stems, ["stem"], "inner", [F.col("tok")])
    known = lookup_join(known, own, ["low"], "left", [F.col("stem")])
    frequent = ~F.col("degree") | (F.col("n_stem") > F.coalesce("n_own", F.lit(0)))
    best = known.where(frequent).groupBy("tok").agg(
        F.max_by(F.struct("stem", "n_stem"), F.struct("n_stem", -F.col("place"), "stem")).alias("best")
    )
    null = F.lit(None).cast("string")
    return best.select(
        F.col("tok").alias("surface"),
        F.col("best.stem").alias("lemma"),
        null.alias("pos"),
        null.alias("nec"),
        F.col("best.n_stem").alias("n_stem"),
    )
