"""Exact dedup over content-defined chunk recipes.

A text is cut where a rolling hash of its last bytes says so, so equal texts are
cut alike. Each chunk has a digest. In one shuffle every distinct (digest, chunk)
pair meets its like, which shows whether any digest stands for two contents; if
none does, a digest *is* a verified identifier. From then on only the ordered
identifier list of a document (its recipe) moves: documents are equal when their
recipes are. A document holding a digest of two contents is compared by its text.

Cases: null text counts as empty; the empty text has the empty recipe and is a
text like any other. Rows with a null ``doc_id`` count in their group and its
size; ``keep_id`` is the largest id there, null if there is none, and then all rows
of that group are kept. Rows repeated with one id and text are each returned, with
the same result, and counted. An empty table gives an empty result. Other columns
are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.batches import each_batch, text_bytes
from quillon.operators.joins import lookup_join
from quillon.session import stored

WINDOW = 16
MIN_CHUNK, MAX_CHUNK, BOUNDARY_BITS = 512, 16_384, 11
DIGEST_BYTES = 16
#: Text that a Python worker holds at a time, besides the batch it comes from.
BATCH_BYTES = 8 << 20
#: Beyond so many colliding digests every document is compared by its text.
MAX_COLLIDED = 10_000


@cache
def _byte_hashes() -> np.ndarray:
    return np.random.default_rng(8).integers(0, 2**32, 256, dtype=np.uint32)


def chunks(data: bytes) -> list[bytes]:
    """Cut ``data`` at content-defined places; the pieces joined give it back."""
    if len(data) <= MIN_CHUNK:
        return [data] if data else []
    rolled = _byte_hashes()[np.frombuffer(data, np.uint8)]
    width, factor = 1, 0x9E3779B1
    while width < WINDOW:
        rolled = rolled[:-width] * np.uint32(factor) + rolled[width:]
        width, factor = 2 * width, factor * factor % 2**32
    marks = np.flatnonzero(rolled >> np.uint32(32 - BOUNDARY_BITS) == 0) + WINDOW
    pieces, start = [], 0
    for mark in [*marks.tolist(), len(data)]:
        while mark - start > MAX_CHUNK:
            pieces.append(data[start : start + MAX_CHUNK])
            start += MAX_CHUNK
        if mark - start >= MIN_CHUNK or mark == len(data) > start:
            pieces.append(data[start:mark])
            start = mark
    return pieces


def _digest(chunk: bytes, size: int) -> bytes:
    return hashlib.blake2b(chunk, digest_size=size).digest()


def chunk_rows(documents: DataFrame, digest_bytes: int = DIGEST_BYTES) -> DataFrame:
    """Distinct (digest, chunk) pairs of the texts."""

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = {piece for data in text_bytes(batch["text"]) for piece in chunks(data)}
        pieces = list(found)
        yield pa.record_batch(
            [
                pa.array([_digest(piece, digest_bytes) for piece in pieces], pa.binary()),
                pa.array(pieces, pa.binary()),
            ],
            ["digest", "chunk"],
        )

    rows = documents.select("text").mapInArrow(
        each_batch(make, BATCH_BYTES), "digest binary, chunk binary"
    )
    return rows.distinct()


def collided_digests(documents: DataFrame, digest_bytes: int = DIGEST_BYTES) -> DataFrame:
    """Digests that stand for more than one chunk."""
    per_digest = chunk_rows(documents, digest_bytes).groupBy("digest").agg(F.count("*").alias("n"))
    return per_digest.where("n > 1").select("digest")


def recipes(
    documents: DataFrame,
    digest_bytes: int = DIGEST_BYTES,
    collided: Iterable[bytes] | None = (),
) -> DataFrame:
    """``doc_id``, ``recipe`` and ``text_sha256`` of each row.

    Texts with a digest of ``collided`` (all texts, if that is None) have the text
    itself appended to the recipe.
    """
    doubtful = None if collided is None else frozenset(collided)

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lists, shas = [], []
        for data in text_bytes(batch["text"]):
            parts = [_digest(piece, digest_bytes) for piece in chunks(data)]
            whole = doubtful is None or not doubtful.isdisjoint(parts)
            lists.append(b"".join(parts) + (data if whole else b""))
            shas.append(hashlib.sha256(data).hexdigest())
        columns = [batch["doc_id"], pa.array(lists, pa.binary()), pa.array(shas, pa.string())]
        yield pa.record_batch(columns, ["doc_id", "recipe", "text_sha256"])

    return documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        each_batch(make, BATCH_BYTES), "doc_id bigint, recipe binary, text_sha256 string"
    )


def exact_groups(documents: DataFrame, digest_bytes: int = DIGEST_BYTES) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the row with the largest ``doc_id`` stays.
    """
    found = [
        bytes(row["digest"])
        for row in collided_digests(documents, digest_bytes).limit(MAX_COLLIDED + 1).collect()
    ]
    rows = recipes(documents, digest_bytes, None if len(found) > MAX_COLLIDED else found)
    groups = (
        rows.groupBy("recipe")
        .agg(F.max("doc_id").alias("group_keep"), F.count("*").alias("n"))
        .where("n > 1")
    )
    joined = lookup_join(rows, groups, ["recipe"], "left", [F.col("doc_id")], small=False)
    keep = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("group_keep"))
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("bigint").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )


def keep_first_copies(documents: DataFrame, single: bool = False) -> DataFrame:
    """The rows of ``documents`` whose text stays, with all their columns.

    Rows of one text that share the id that stays, or where all ids are null, all stay,
    or with ``single`` any one of them.
    """
    kept = exact_groups(documents).where("kept")
    ids = kept.select(
        F.coalesce("doc_id", F.lit(-1)).alias("__id"),
        F.col("doc_id").isNull().alias("__none"),
        F.col("text_sha256").alias("__sha"),
    )
    same = (
        (F.coalesce(documents["doc_id"].cast("bigint"), F.lit(-1)) == F.col("__id"))
        & (documents["doc_id"].isNull() == F.col("__none"))
        & (F.sha2(F.coalesce(documents["text"], F.lit("")).cast("binary"), 256) == F.col("__sha"))
    )
    if not single:
        return documents.join(ids, same, "left_semi")
    keys = ["__id", "__none", "__sha"]
    ids = stored(ids.groupBy(*keys).agg((F.count("*") > 1).alias("__several")), "kept")
    one = documents.join(ids.where("not __several"), same, "left_semi")
    several = ids.where("__several")
    if several.isEmpty():
        return one
    row = F.struct(*[documents[name] for name in documents.columns]).alias("row")
    found = documents.join(several, same).select(*keys, row)
    return one.unionByName(found.groupBy(*keys).agg(F.first("row").alias("row")).select("row.*"))
