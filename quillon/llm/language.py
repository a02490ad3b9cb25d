"""Language identification by rank-order n-gram profiles.

A profile is the most frequent letter n-grams (one to three characters, words marked
off by a blank) in rank order. A text is compared to each language by the out-of-place
distance: how far each of its own most frequent n-grams is from its rank in the
profile, an absent one counting as the profile's length. Counting covers every
training text whole; counts are added up per batch before the shuffle. The profiles
(languages x ``PROFILE`` rows) are what prediction broadcasts.

``score`` is 1 - distance / largest possible distance. Ties go to the smaller language
name, ties between equally frequent n-grams to the smaller n-gram.

Cases: a text that is null or has no letter gets ``und`` and 0. With nothing learned
every text gets ``und``. A document with a null ``doc_id`` or null ``lang`` is not
learned from, and one with a null id is not held out. Each row stands for itself, also
with a repeated id. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.llm.batches import each_batch, slices

UNDETERMINED = "und"
PROFILE, DOCUMENT_NGRAMS = 400, 300
#: A profile set is broadcast; more languages than this is an error, not a cut.
MAX_LANGUAGES = 2_000
#: Below this score a text resembles no language that was learned.
LEAST_SCORE = 0.25
BLANK = 32


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngrams(text: str) -> np.ndarray:
    """Every n-gram of ``text`` as a number: three code points of 21 bits each."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return np.empty(0, np.int64)
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    marked = np.where(letter, points, BLANK)[kept].astype(np.int64)
    ends = np.array([BLANK], np.int64)
    marked = np.concatenate((ends, marked, ends))
    marked = marked[np.append(True, (marked[1:] != BLANK) | (marked[:-1] != BLANK))]
    pairs = marked[:-1] << 21 | marked[1:]
    triples = (pairs[:-1] << 21 | marked[2:])[marked[1:-1] != BLANK]
    return np.concatenate((marked[marked != BLANK], pairs, triples))


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(keys, return_counts=True)


def in_rank_order(keys: np.ndarray, most: int) -> np.ndarray:
    """The most frequent of ``keys``, most frequent first."""
    found, counts = _counted(keys)
    return found[np.argsort(-counts, kind="stable")[:most]]


def held_out() -> Column:
    """Documents that the profiles must not be learned from."""
    number = F.crc32(F.col("doc_id").cast("bigint").cast("string").cast("binary"))
    return F.coalesce(F.pmod(number, F.lit(3)) == 1, F.lit(False))


def learn_profiles(labelled: DataFrame, size: int = PROFILE) -> DataFrame:
    """``lang, ngram, rank`` (from 0) from rows of ``lang, text``."""

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts, langs = batch["text"].to_pylist(), batch["lang"].to_pylist()
        for start, end in slices([len(t) for t in texts], 1_000_000):
            by_lang: dict[str, list] = {}
            for text, lang in zip(texts[start:end], langs[start:end], strict=True):
                by_lang.setdefault(lang, []).append(ngrams(text))
            for lang, found in by_lang.items():
                keys, counts = _counted(np.concatenate(found))
                yield pa.record_batch(
                    [pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(counts)],
                    ["lang", "ngram", "n"],
                )

    rows = labelled.where("lang is not null and text is not null").select("lang", "text")
    counted = rows.mapInArrow(each_batch(make), "lang string, ngram bigint, n bigint")
    totals = counted.groupBy("lang", "ngram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "ngram")
    # Filtered on the row number itself, Spark keeps ``size`` rows of each task's part of a
    # language before the shuffle.
    ranked = totals.withColumn("place", F.row_number().over(order)).where(F.col("place") <= size)
    return ranked.select("lang", "ngram", (F.col("place") - 1).alias("rank"))


class Profiles:
    """Learned profiles, ready for comparison.

    They are ``full`` where each has ``PROFILE`` n-grams: enough to tell that a text
    resembles none of them.
    """

    def __init__(self, rows: list) -> None:
        by_lang: dict[str, list] = {}
        for lang, ngram, rank in rows:
            by_lang.setdefault(lang, []).append((ngram, rank))
        if len(by_lang) > MAX_LANGUAGES:
            raise ValueError(f"{len(by_lang)} languages; at most {MAX_LANGUAGES} can be broadcast")
        self.by_lang = {
            lang: np.array(sorted(found), np.int64).T for lang, found in sorted(by_lang.items())
        }
        self.full = bool(by_lang) and min(len(found) for found in by_lang.values()) >= PROFILE

    def predict(self, text: str | None) -> tuple[str, float]:
        own = in_rank_order(ngrams(text or ""), DOCUMENT_NGRAMS)
        if not len(own) or not self.by_lang:
            return UNDETERMINED, 0.0
        places, best = np.arange(len(own)), None
        for lang, (keys, ranks) in self.by_lang.items():
            at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            away = np.minimum(np.abs(ranks[at] - places), PROFILE)
            distance = int(np.where(keys[at] == own, away, PROFILE).sum())
            if best is None or distance < best[0]:
                best = (distance, lang)
        return best[1], 1.0 - best[0] / (PROFILE * len(own))


def _learned(documents: DataFrame) -> Profiles:
    training = documents.where(F.col("doc_id").isNotNull() & ~held_out())
    known = training.where("lang is not null and text is not null").select("lang").distinct()
    languages = known.limit(MAX_LANGUAGES + 1).count()
    if languages > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages; their profiles cannot be broadcast")
    return Profiles([tuple(row) for row in learn_profiles(training).collect()])


def predict_languages(documents: DataFrame, profiles: Profiles | None = None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of each row.

    Learns from the rows of ``documents`` that are not held out, unless given profiles.
    """
    shared = documents.sparkSession.sparkContext.broadcast(profiles or _learned(documents))

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [shared.value.predict(text.as_py()) for text in batch["text"]]
        columns = [batch["doc_id"], batch["held_out"]]
        columns += [pa.array([x[0] for x in found], pa.string())]
        columns += [pa.array([x[1] for x in found], pa.float64())]
        yield pa.record_batch(columns, ["doc_id", "held_out", "lang_pred", "score"])

    rows = documents.select(F.col("doc_id").cast("bigint"), held_out().alias("held_out"), "text")
    schema = "doc_id bigint, held_out boolean, lang_pred string, score double"
    return rows.mapInArrow(each_batch(make), schema)


def drop_undetermined(documents: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``documents``, with all their columns, whose text has a language.

    A text goes that has no letter, or that resembles no profile: its best score is below
    ``least``. The latter holds only where all profiles are full; with little or nothing
    learned, every text with a letter stays. A row without a ``lang`` gets the predicted
    one, if any; a given ``lang`` is left as it is, also a wrong one.
    """
    shared = documents.sparkSession.sparkContext.broadcast(_learned(documents))
    text_at, lang_at = documents.columns.index("text"), documents.columns.index("lang")

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        profiles, kept, langs = shared.value, [], []
        for text, lang in zip(batch.column(text_at), batch.column(lang_at).to_pylist(), strict=True):
            text = text.as_py()
            found, score = profiles.predict(text)
            lettered = found != UNDETERMINED or not profiles.by_lang and has_letter(text)
            kept.append(lettered and (score >= least or not profiles.full))
            langs.append(found if lang is None and found != UNDETERMINED else lang)
        columns = list(batch.columns)
        columns[lang_at] = pa.array(langs, batch.schema.field(lang_at).type)
        yield pa.record_batch(columns, batch.schema).filter(pa.array(kept, pa.bool_()))

    schema = T.StructType(documents.schema.fields)
    return documents.mapInArrow(each_batch(make), schema)
