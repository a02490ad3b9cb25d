"""Near-duplicate documents by MinHash and a multi-index Hamming join.

Each distinct shingle set gets a b-bit signature: ``CHUNKS`` chunks of ``WIDTH``
MinHash values of 16 bits. Two signatures that differ in fewer than ``CHUNKS * (ERRORS
+ 1)`` values differ in at most ``ERRORS`` values of some chunk (pigeonhole), so each
chunk is entered once for every choice of ``ERRORS`` values left out, and any such pair
meets under an equal key. With 10 chunks of 5 and one error that guarantees all pairs
up to a distance of 19 of 50; pairs that meet at up to ``FAR`` are verified too. A pair
of similarity 0.8 is missed with a probability of about 2e-6.

Pairs under a key are never all made. First every set under a key is paired with the
smallest one there; pairs near enough are confirmed on their full shingle sets, and
their components found. Only keys that still hold several components are looked at
again, in blocks of bounded size that hold the texts: pairs across components within
``FAR`` are confirmed in place, nearest first, each under its first common key, and only
links that join two components come out. What is linked is then exactly what all
candidate pairs would link.

Words are runs of anything but ASCII white space, A-Z in lower case; a set holds the
distinct shingles of four words (one of all words, if there are fewer). Sets are
compared as 64-bit shingle hashes made of 64-bit BLAKE2b digests of their words (two
given words share one with a chance of 2^-64); equal sets, by a 128-bit digest of these.

Cases: null text counts as empty; a text without words has size 0 and stands alone.
A row with a null ``doc_id`` is linked with nothing, has a null ``component_id`` and is
kept. Rows that share a ``doc_id`` are one document: linked with all that either is. An empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.batches import each_batch, text_bytes
from quillon.llm.components import components
from quillon.operators.joins import lookup_join
from quillon.session import stored

SHINGLE = 4
CHUNKS, WIDTH, ERRORS = 10, 5, 1
VALUES = CHUNKS * WIDTH
FAR = 25
PERCENT = 80
#: Most sets, and shingles, of a block of a key.
BLOCK, BLOCK_SHINGLES = 2_048, 2_000_000

_RANDOM = np.random.default_rng(1)
_SLOPES = _RANDOM.integers(0, 2**63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _RANDOM.integers(0, 2**63, VALUES, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
#: Words whose hashes a task remembers; beyond, it starts over.
KNOWN_WORDS = 300_000


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    """The 64-bit BLAKE2b digest of each word that is asked for."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        self[word] = value
        return value


_KNOWN = _WordHashes()


def _word_hashes(data: bytes) -> np.ndarray:
    words = data.lower().split()
    return np.fromiter(map(_KNOWN.__getitem__, words), np.uint64, len(words))


def shingle_set(data: bytes) -> np.ndarray:
    """The sorted hashes of the distinct shingles of a text."""
    words = _word_hashes(data)
    size = min(SHINGLE, len(words))
    if not size:
        return words
    count = len(words) - size + 1
    found = np.full(count, size, np.uint64)
    for at in range(size):
        found = _mixed(found + words[at : at + count] + np.uint64(_BASE))
    return np.unique(found)


def signature(shingles: np.ndarray) -> bytes:
    """16 bits of each MinHash value."""
    least = np.full(VALUES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 2048):
        some = shingles[start : start + 2048, None] * _SLOPES + _OFFSETS
        np.minimum(least, some.min(0), out=least)
    return (_mixed(least) >> np.uint64(48)).astype(np.uint16).tobytes()


def similar(one: np.ndarray, two: np.ndarray) -> bool:
    """Whether the sets share ``PERCENT`` of their union or more."""
    if 100 * min(len(one), len(two)) < PERCENT * max(len(one), len(two)):
        return False
    both = len(np.intersect1d(one, two, assume_unique=True))
    return 100 * both >= PERCENT * (len(one) + len(two) - both)


def signatures(documents: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, set_digest, sig`` of each row; digest and sig null if empty."""

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sizes, digests, sigs = [], [], []
        for data in text_bytes(batch["text"]):
            shingles = shingle_set(data)
            sizes.append(len(shingles))
            full = len(shingles) > 0
            digest = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
            digests.append(digest if full else None)
            sigs.append(signature(shingles) if full else None)
        columns = [batch["doc_id"], pa.array(sizes, pa.int64())]
        columns += [pa.array(digests, pa.binary()), pa.array(sigs, pa.binary())]
        yield pa.record_batch(columns, ["doc_id", "n_shingles", "set_digest", "sig"])

    rows = documents.select(F.col("doc_id").cast("bigint"), "text")
    schema = "doc_id bigint, n_shingles bigint, set_digest binary, sig binary"
    return rows.mapInArrow(each_batch(make), schema)


def index_keys(sets: DataFrame) -> DataFrame:
    """``key, slot, rep``: each signature under every chunk with one value left out.

    ``slot`` tells the chunk and the value, and is part of the key.
    """

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        values = np.frombuffer(b"".join(batch["sig"].to_pylist()), np.uint16)
        values = values.reshape(-1, CHUNKS, WIDTH).astype(np.uint64)
        keys = []
        for left_out in range(WIDTH):
            kept = np.delete(values, left_out, 2)
            key = np.arange(CHUNKS, dtype=np.uint64) * np.uint64(WIDTH) + np.uint64(left_out)
            for at in range(WIDTH - ERRORS):
                key = _mixed((key << np.uint64(16)) + kept[:, :, at] + np.uint64(_BASE))
            keys.append(key)
        keys = np.stack(keys, 2).reshape(len(values), -1)
        slots = np.tile(np.arange(CHUNKS * WIDTH, dtype=np.int32), len(values))
        reps = np.repeat(batch["rep"].to_numpy(), keys.shape[1])
        columns = [pa.array(keys.ravel().view(np.int64)), pa.array(slots), pa.array(reps)]
        yield pa.record_batch(columns, ["key", "slot", "rep"])

    return sets.select("rep", "sig").mapInArrow(each_batch(make), "key bigint, slot int, rep bigint")


def _distances(one: list[bytes], two: list[bytes]) -> np.ndarray:
    a, b = (np.frombuffer(b"".join(x), np.uint16).reshape(-1, VALUES) for x in (one, two))
    return (a != b).sum(1)


def _near_pairs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose signatures differ in ``FAR`` values at most."""

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        near = _distances(batch["sig_a"].to_pylist(), batch["sig_b"].to_pylist()) <= FAR
        yield batch.select(["a", "b"]).filter(pa.array(near))

    joined = pairs.join(sets.select(F.col("rep").alias("a"), F.col("sig").alias("sig_a")), "a")
    joined = joined.join(sets.select(F.col("rep").alias("b"), F.col("sig").alias("sig_b")), "b")
    rows = joined.select("a", "b", "sig_a", "sig_b").mapInArrow(each_batch(make), "a bigint, b bigint")
    return rows.distinct()


def _texts_of(ids: DataFrame, documents: DataFrame) -> DataFrame:
    """``id, text`` of the documents with one of the ``ids`` (id), written once."""
    texts = documents.select(F.col("doc_id").cast("bigint").alias("id"), "text")
    return stored(lookup_join(texts, ids.distinct(), ["id"], "left_semi"), "members")


def confirmed(pairs: DataFrame, documents: DataFrame) -> DataFrame:
    """The pairs ``a, b`` of documents whose full shingle sets are similar, as ``u, v``."""
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    wanted = _texts_of(ids, documents)

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found, last, center = [], None, None
        one, two = text_bytes(batch["text_a"]), text_bytes(batch["text_b"])
        for a, b in zip(one, two, strict=True):
            if b != last:
                last, center = b, shingle_set(b)
            found.append(similar(shingle_set(a), center))
        yield batch.select(["u", "v"]).filter(pa.array(found, pa.bool_()))

    joined = pairs.join(wanted.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    joined = joined.join(wanted.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    rows = joined.select(F.col("a").alias("u"), F.col("b").alias("v"), "text_a", "text_b")
    return rows.mapInArrow(each_batch(make), "u bigint, v bigint")


def _first_common(equal: np.ndarray) -> np.ndarray:
    """The first slot under which each pair meets, from which of its values are equal."""
    chunked = equal.reshape(-1, CHUNKS, WIDTH)
    counts = chunked.sum(2)
    chunk = (counts >= WIDTH - ERRORS).argmax(1)
    rows = np.arange(len(equal))
    return chunk * WIDTH + np.where(counts[rows, chunk] == WIDTH, 0, chunked[rows, chunk].argmin(1))


def _joining_links(table: pa.Table) -> pa.Table:
    """Confirmed links of a block (or two) of a key, each joining two components."""
    table = table.take(np.argsort(table["rep"].to_numpy(), kind="stable"))
    reps, own, slot = table["rep"].to_numpy(), table["own"].to_numpy(), table["slot"][0].as_py()
    _, label = np.unique(table["component"].to_numpy(), return_inverse=True)
    values = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint16).reshape(-1, VALUES)
    texts = text_bytes(table["text"].combine_chunks())
    apart = table["i"][0].as_py() != table["j"][0].as_py()
    sets: dict[int, np.ndarray] = {}

    def set_of(row: int) -> np.ndarray:
        if row not in sets:
            sets[row] = shingle_set(texts[row])
        return sets[row]

    one, two = [], []
    for at in range(1, len(reps)):
        across = label[:at] != label[at]
        if apart:
            across &= own[:at] != own[at]
        rows = np.flatnonzero(across)
        equal = values[rows] == values[at]
        distance = VALUES - equal.sum(1)
        near = np.flatnonzero(distance <= FAR)
        near = near[_first_common(equal[near]) == slot]
        for row in rows[near[np.argsort(distance[near], kind="stable")]].tolist():
            if label[row] != label[at] and similar(set_of(row), set_of(at)):
                one.append(reps[at])
                two.append(reps[row])
                label[label == label[row]] = label[at]
    return pa.table({"u": pa.array(one, pa.int64()), "v": pa.array(two, pa.int64())})


def _across(labelled: DataFrame, sets: DataFrame, documents: DataFrame, block: int) -> DataFrame:
    """Links between the components of keys that hold several.

    ``labelled`` has ``key, slot, rep, component``. A key is dealt into blocks by its sets
    and shingles, and each two of its blocks meet in one group.
    """
    sized = labelled.join(sets.select("rep", "n_shingles"), "rep")
    blocks = F.greatest(
        F.ceil(F.count("*") / block), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)
    ).cast("int")
    mixed = (
        sized.groupBy("key")
        .agg(
            F.min("component").alias("least"),
            F.max("component").alias("most"),
            blocks.alias("blocks"),
        )
        .where("least != most")
        .select("key", "blocks")
    )
    several = stored(labelled.join(mixed, "key"), "mixed")
    texts = _texts_of(several.select(F.col("rep").alias("id")), documents)
    others = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda o: F.struct(F.least(o, F.col("own")).alias("i"), F.greatest(o, F.col("own")).alias("j")),
    )
    dealt = (
        several.join(sets.select("rep", "sig"), "rep")
        .join(texts.withColumnRenamed("id", "rep"), "rep")
        .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        .withColumn("meets", F.explode(others))
        .select("key", "meets.i", "meets.j", "own", "slot", "rep", "component", "sig", "text")
    )
    return dealt.groupBy("key", "i", "j").applyInArrow(_joining_links, "u bigint, v bigint").distinct()


def _same_id(named: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between the sets of rows that share a ``doc_id``; none, as a rule."""
    ends = named.groupBy("doc_id").agg(
        F.min("set_digest").alias("least"), F.max("set_digest").alias("most")
    )
    repeated = ends.where("least != most").select("doc_id")
    several = named.select("doc_id", "set_digest").join(repeated, "doc_id", "left_semi")
    return several.join(sets.select("set_digest", "rep"), "set_digest").select(
        F.col("rep").alias("u"), F.col("doc_id").alias("v")
    )


def near_groups(documents: DataFrame, block: int = BLOCK) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of each row."""
    rows = stored(signatures(documents), "signatures")
    named = rows.where("doc_id is not null and set_digest is not null")
    sets = named.groupBy("set_digest").agg(
        F.min("doc_id").alias("rep"),
        F.first("sig").alias("sig"),
        F.first("n_shingles").alias("n_shingles"),
        F.count("*").alias("copies"),
    )
    sets = stored(sets, "sets")
    keys = index_keys(sets)
    centers = keys.groupBy("key").agg(F.min("rep").alias("center"), F.count("*").alias("n"))
    shared = stored(keys.join(centers.where("n > 1"), "key"), "shared")
    stars = shared.where("rep != center").select(F.col("rep").alias("a"), F.col("center").alias("b"))
    tried = stored(_near_pairs(stars.distinct(), sets), "pairs")
    links = stored(confirmed(tried, documents).unionByName(_same_id(named, sets)), "links")
    found = components(links)

    # Keys that hold several components now.
    labelled = shared.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "key", "slot", "rep", F.coalesce("component", "rep").alias("component")
    )
    more = stored(_across(labelled, sets, documents, block), "links")
    if not more.isEmpty():
        stars = found.select(F.col("node").alias("u"), F.col("component").alias("v"))
        found = components(stars.unionByName(more))

    # One row per set whose documents are not just themselves.
    classes = (
        sets.join(found.withColumnRenamed("node", "rep"), "rep", "left")
        .where("copies > 1 or component is not null")
        .select("set_digest", F.coalesce("component", "rep").alias("component"))
    )
    joined = lookup_join(rows, classes, ["set_digest"], "left", [F.col("doc_id")], small=False)
    class_id = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return joined.select(
        "doc_id",
        "n_shingles",
        class_id.alias("component_id"),
        F.coalesce(F.col("doc_id") == class_id, F.lit(True)).alias("kept"),
    )


def keep_one_of_each(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` that stay, with all their columns."""
    dropped = near_groups(documents).where("not kept").select(F.col("doc_id").alias("__id"))
    same = documents["doc_id"].cast("bigint") == F.col("__id")
    return documents.join(dropped.distinct(), same, "left_anti")
