"""Quality classifier: logistic regression on hashed word n-grams, trained by
follow-the-regularised-leader (proximal) updates.

A text is described by four groups of hashed features: its words and pairs of adjacent
words, and the same of word *shapes* (letters and digits squeezed to their class,
punctuation kept). A feature's value is the root of its count; each group is scaled to
length 1/2, so that a long text weighs no more than a short one. Scores are sparse dot
products with the weights, through the logistic function.

The model is fitted on a bounded sample of the labelled rows that may be learned from:
``SAMPLE`` of them, those whose hashed id is smallest. They pass one task in a stream,
``EPOCHS`` times in an order of their own, one batch in memory at a time. What it hands
on, ``BUCKETS`` weights at most, is broadcast; every text is scored whole where it is read.

Cases: a text that is null or has no words has the features of no group, and gets the
score of the intercept. With nothing learned every score is 0.5. Labels other than 0 and
1, and labels or documents with a null ``doc_id``, are not learned from; a document with
several labels is learned once with each. A document with a null id is not held out.
Each row stands for itself, also with a repeated id. An empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm.batches import each_batch, text_bytes

#: Buckets of each group; the one after them all holds the intercept.
GROUP_BUCKETS = 1 << 16
INTERCEPT = 4 * GROUP_BUCKETS
BUCKETS = INTERCEPT + 1
SAMPLE, EPOCHS = 10_000, 4
#: Step size, its offset, and the two penalties.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.05, 0.01
THRESHOLD = 0.7

_CLASSES = bytes(
    ord("A") if 65 <= b <= 90 else ord("a") if 97 <= b <= 122 or b >= 128 else ord("0") if 48 <= b <= 57 else b
    for b in range(256)
)
_SQUEEZED = np.isin(np.arange(256), list(b"Aa0"))
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)


def shapes(text: bytes) -> list[bytes]:
    """The words with each run of capitals, other letters or digits as one character."""
    seen = np.frombuffer(text.translate(_CLASSES), np.uint8)
    kept = np.ones(len(seen), bool)
    kept[1:] = (seen[1:] != seen[:-1]) | ~_SQUEEZED[seen[1:]]
    return seen[kept].tobytes().split()


def _buckets(numbers: np.ndarray, group: int) -> np.ndarray:
    mixed = (numbers + np.uint64(group)) * _MULTIPLIERS[0]
    mixed ^= mixed >> np.uint64(29)
    own = (mixed * _MULTIPLIERS[1]) >> np.uint64(48)
    return own.astype(np.int64) + group * GROUP_BUCKETS


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their values; the intercept is among them."""
    places, values = [np.array([INTERCEPT])], [np.ones(1)]
    for at, words in enumerate((text.split(), shapes(text))):
        ones = np.fromiter(map(crc32, words), np.uint64, len(words))
        pairs = (ones[:-1] << np.uint64(32)) | ones[1:]
        for size, numbers in enumerate((ones, pairs)):
            if len(numbers):
                found, counts = np.unique(_buckets(numbers, 2 * at + size), return_counts=True)
                roots = np.sqrt(counts)
                places.append(found)
                values.append(roots * (0.5 / np.sqrt(counts.sum())))
    return np.concatenate(places), np.concatenate(values)


class Leader:
    """Weights under follow-the-regularised-leader updates, one example at a time."""

    def __init__(self) -> None:
        self.z, self.n = np.zeros(BUCKETS), np.zeros(BUCKETS)

    def weights(self, places: np.ndarray) -> np.ndarray:
        z, root = self.z[places], np.sqrt(self.n[places])
        # The intercept is not drawn to 0.
        penalty = np.where(places == INTERCEPT, 0.0, L1)
        drawn = np.sign(z) * np.maximum(np.abs(z) - penalty, 0.0)
        return -drawn / ((BETA + root) / ALPHA + L2)

    def learn(self, places: np.ndarray, values: np.ndarray, label: int) -> None:
        weights = self.weights(places)
        slopes = (logistic(weights @ values) - label) * values
        n = self.n[places]
        steps = (np.sqrt(n + slopes**2) - np.sqrt(n)) / ALPHA
        self.z[places] += slopes - steps * weights
        self.n[places] = n + slopes**2


def logistic(x: float) -> float:
    return float(1.0 / (1.0 + np.exp(-np.clip(x, -500, 500))))


def _fold() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("bigint").cast("string").cast("binary")), F.lit(4))


def held_out() -> Column:
    """Documents whose labels must not be learned from."""
    return F.coalesce(_fold() == 2, F.lit(False))


def training_rows(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``epoch, turn, label, text``: the sampled labelled rows, once per epoch."""
    usable = labels.select(F.col("doc_id").cast("bigint"), F.col("quality").cast("int").alias("label"))
    usable = usable.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out())
    picked = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample)
    texts = documents.select(F.col("doc_id").cast("bigint"), "text")
    epochs = F.explode(F.sequence(F.lit(0), F.lit(EPOCHS - 1))).alias("epoch")
    return (
        texts.join(F.broadcast(picked), "doc_id")
        .select(epochs, "doc_id", "label", "text")
        .withColumn("turn", F.xxhash64("epoch", "doc_id"))
    )


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """The weights, ``BUCKETS`` of them."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader = Leader()
        for batch in batches:
            for text, label in zip(text_bytes(batch["text"]), batch["label"].to_pylist(), strict=True):
                leader.learn(*features(text), label)
        weights = leader.weights(np.arange(BUCKETS))
        places = np.flatnonzero(weights)
        yield pa.record_batch([pa.array(places), pa.array(weights[places])], ["place", "weight"])

    rows = training_rows(documents, labels, sample)
    order = ["epoch", "turn", "doc_id", "label", "text"]
    ordered = rows.repartition(1).sortWithinPartitions(*order).select("label", "text")
    found = ordered.mapInArrow(train, "place bigint, weight double").collect()
    weights = np.zeros(BUCKETS)
    for place, weight in found:
        weights[place] = weight
    return weights


def scores(weights: np.ndarray, texts: Iterable[bytes]) -> list[float]:
    found = []
    for text in texts:
        places, values = features(text)
        found.append(logistic(weights[places] @ values))
    return found


def quality_scores(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each row of ``documents``."""
    weights = fit(documents, labels, sample)
    shared = documents.sparkSession.sparkContext.broadcast(weights)

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = np.array(scores(shared.value, text_bytes(batch["text"])), np.float64)
        columns = [batch["doc_id"], batch["held_out"], pa.array(found)]
        columns.append(pa.array((found >= THRESHOLD).astype(np.int32)))
        yield pa.record_batch(columns, ["doc_id", "held_out", "score", "predicted"])

    rows = documents.select(F.col("doc_id").cast("bigint"), held_out().alias("held_out"), "text")
    schema = "doc_id bigint, held_out boolean, score double, predicted int"
    return rows.mapInArrow(each_batch(make), schema)
