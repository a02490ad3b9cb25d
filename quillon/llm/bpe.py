"""Byte-level BPE encoding and decoding by forced-boundary splitting.

Two bytes that are neighbours inside no vocabulary token can never be merged over,
so every such pair is a certain cut. A text is first cut as the tokenizer file says
(special tokens, then the pre-token pattern), each distinct pre-token is cut further
at forced boundaries, and the fragments are encoded on their own; the ids of a text
are the ids of its fragments in a row. Decoding joins the bytes of the ids.

The vocabulary is read once by the driver and broadcast; its size is fixed by the
tokenizer file (some 50,000 entries), whatever the corpus. Work is per row, without
a shuffle.

Cases: null text counts as empty and gives no ids and the digests of the empty
string. Each row stands for itself, also with a null or repeated ``doc_id``. An empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm.batches import slices

# Fixed value: the pre-token pattern of the byte-level tokenizer.
PRE_TOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    r"| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
SPACE_BEGINS = regex.compile(r"(?<=\P{White_Space})\p{White_Space}")
#: Characters that are cut and encoded in one step.
PART = 2_000_000
#: Remembered pre-tokens of a task; beyond, it starts over (memory, not results).
CACHE_SIZE = 300_000
#: Fragments are merged together with others of up to these lengths.
WIDTHS = (8, 12, 16, 24, 40)
NO_RANK = 2**40


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in the vocabulary file.

    Printable bytes stand for themselves, the others are numbered from 256 up.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}


def read_tokenizer(path: str) -> dict:
    """What encoding needs of a tokenizer file, as plain values that can be broadcast."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    alphabet, model = byte_alphabet(), content["model"]
    ids = {bytes(alphabet[c] for c in token): n for token, n in model["vocab"].items()}
    merges = {}
    for rank, merge in enumerate(model["merges"]):
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        one, two = (bytes(alphabet[c] for c in part) for part in (left, right))
        merges[ids[one], ids[two]] = (rank, ids[one + two])
    special = {token["content"]: token["id"] for token in content["added_tokens"]}
    return {"ids": ids, "merges": merges, "special": special}


class ForcedBoundaryCodec:
    """Encoder and decoder of one task, with the pre-tokens it has met."""

    def __init__(self, tokenizer: dict, cache_size: int = CACHE_SIZE) -> None:
        ids, merges, self.special = (tokenizer[k] for k in ("ids", "merges", "special"))
        self.merges = merges
        self.single = np.array([ids[bytes([byte])] for byte in range(256)], np.int64)
        self.inside = np.zeros((256, 256), bool)
        for token in ids:
            self.inside[tuple(token[:-1]), tuple(token[1:])] = True
        keys = np.array([one << 32 | two for one, two in merges] + [2**62], np.int64)
        order = np.argsort(keys)
        self.pairs = keys[order]
        self.ranks = np.array([m[0] for m in merges.values()] + [NO_RANK], np.int64)[order]
        self.merged = np.array([m[1] for m in sorted(merges.values())], np.int64)
        self.bytes_of = {n: token for token, n in ids.items()}
        self.bytes_of |= {n: text.encode() for text, n in self.special.items()}
        self.pattern = regex.compile(PRE_TOKEN)
        names = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile(f"({'|'.join(map(regex.escape, names))})") if names else None
        self.special_joined = {text: str(n) for text, n in self.special.items()}
        self.special_data = {text: text.encode() for text in self.special}
        # Of each pre-token that was met: its ids, joined by commas, and their bytes.
        self.joined, self.data = dict(self.special_joined), dict(self.special_data)
        self.cache_size = cache_size

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pairs = left << 32 | right
        at = np.searchsorted(self.pairs, pairs)
        return np.where(self.pairs[at] == pairs, self.ranks[at], NO_RANK)

    def fragments(self, tokens: list[bytes]) -> tuple[list[bytes], list[int]]:
        """The tokens cut at every forced boundary, and how many fragments each has."""
        data = b"".join(tokens)
        seen = np.frombuffer(data, np.uint8)
        ends = np.cumsum([len(token) for token in tokens])
        cut = ~self.inside[seen[:-1], seen[1:]]
        cut[ends[:-1] - 1] = True
        places = np.append(np.flatnonzero(cut) + 1, len(data))
        counts = np.diff(np.searchsorted(places, ends, "right"), prepend=0)
        starts = [0, *places[:-1].tolist()]
        return [data[i:j] for i, j in zip(starts, places.tolist(), strict=True)], counts.tolist()

    def encode_fragments(self, fragments: list[bytes]) -> list[list[int]]:
        """Merge neighbours, lowest rank first and leftmost among equals, in all at once."""
        sizes = np.array([len(fragment) for fragment in fragments])
        done: list[list[int]] = [[]] * len(fragments)
        least = 0
        for most in WIDTHS:
            rows = np.flatnonzero((sizes > least) & (sizes <= most))
            for start in range(0, len(rows), 20_000):
                some = rows[start : start + 20_000]
                found = self._merge_rows([fragments[i] for i in some], sizes[some], most)
                for i, ids in zip(some.tolist(), found, strict=True):
                    done[i] = ids
            least = most
        for i in np.flatnonzero(sizes > least).tolist():
            done[i] = self._encode_long(self.single[list(fragments[i])].tolist())
        return done

    def _merge_rows(self, fragments: list[bytes], sizes: np.ndarray, width: int) -> list:
        padded = b"".join(fragment.ljust(width, b"\0") for fragment in fragments)
        parts = self.single[np.frombuffer(padded, np.uint8)].reshape(-1, width)
        counts = sizes.copy()
        ranks = self._rank(parts[:, :-1], parts[:, 1:])
        columns = np.arange(width)
        ranks[columns[:-1] >= counts[:, None] - 1] = NO_RANK
        ranks = np.pad(ranks, ((0, 0), (0, 1)), constant_values=NO_RANK)
        out = np.zeros_like(parts)
        rows = np.arange(len(parts))
        while len(rows):
            at = ranks.argmin(1)
            here = np.arange(len(rows))
            best = ranks[here, at]
            live = best < NO_RANK
            out[rows[~live]] = parts[~live]
            counts_live = counts[rows[live]] - 1
            counts[rows[live]] = counts_live
            rows, at, best = rows[live], at[live], best[live]
            parts, ranks = parts[live], ranks[live]
            if not len(rows):
                break
            here = np.arange(len(rows))
            source = np.minimum(columns + (columns > at[:, None]), width - 1)
            parts = np.take_along_axis(parts, source, 1)
            # The rank at a place is that of the pair starting there; the merged pair's goes.
            ranks = np.take_along_axis(ranks, source, 1)
            parts[here, at] = self.merged[best]
            left = np.maximum(at - 1, 0)
            before = self._rank(parts[here, left], parts[here, at])
            ranks[here, left] = np.where(at > 0, before, ranks[here, left])
            after = self._rank(parts[here, at], parts[here, np.minimum(at + 1, width - 1)])
            ranks[here, at] = np.where(at + 1 < counts_live, after, NO_RANK)
            ranks[:, -1] = NO_RANK
        return [row[:n] for row, n in zip(out.tolist(), counts.tolist(), strict=True)]

    def _encode_long(self, parts: list) -> list[int]:
        """The same with a heap over a linked list, for fragments of any length."""
        merges, size = self.merges, len(parts)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = []

        def offer(left: int, right: int) -> None:
            if found := merges.get((parts[left], parts[right])):
                heapq.heappush(heap, (found[0], left, right, parts[left], parts[right], found[1]))

        for left in range(size - 1):
            offer(left, left + 1)
        while heap:
            _, left, right, one, two, new = heapq.heappop(heap)
            if parts[left] != one or parts[right] != two or after[left] != right:
                continue
            parts[left], parts[right] = new, None
            after[left] = after[right]
            if after[right] < size:
                before[after[right]] = left
                offer(left, after[right])
            if before[left] >= 0:
                offer(before[left], left)
        return [part for part in parts if part is not None]

    def encode_tokens(self, tokens: Iterable[str]) -> dict[str, list[int]]:
        """The ids of each distinct pre-token."""
        distinct = list(dict.fromkeys(tokens))
        if not distinct:
            return {}
        cut, counts = self.fragments([token.encode() for token in distinct])
        found = iter(self.encode_fragments(cut))
        return {
            token: list(chain.from_iterable(islice(found, count)))
            for token, count in zip(distinct, counts, strict=True)
        }

    def _pre_tokens(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens and special tokens of a text, a bounded part of it at a time."""
        parts = self.cut.split(text) if any(name in text for name in self.special) else [text]
        for part in parts:
            if part in self.special:
                yield [part]
                continue
            start = 0
            while len(part) - start > PART:
                # The pattern never looks past a place where white space begins.
                found = SPACE_BEGINS.search(part, start + PART)
                if not found:
                    break
                yield self.pattern.findall(part, start, found.start())
                start = found.start()
            yield self.pattern.findall(part, start)

    def _learn(self, tokens: list[str]) -> None:
        """Encode those of the pre-tokens that are new."""
        if len(self.joined) > self.cache_size:
            self.joined, self.data = dict(self.special_joined), dict(self.special_data)
        new = set(tokens).difference(self.joined)
        for token, ids in self.encode_tokens(new).items():
            self.joined[token] = ",".join(map(str, ids))
            self.data[token] = b"".join(map(self.bytes_of.__getitem__, ids))

    def round_trips(self, texts: list[str]) -> Iterator[tuple[str, bytes]]:
        """The ids of each text joined by commas, and their bytes.

        Both are remembered with each pre-token, so that nothing is done id by id.
        """
        for start, end in slices([len(text) for text in texts], PART):
            parts = [list(self._pre_tokens(text)) for text in texts[start:end]]
            if end - start > 1:
                self._learn([token for some in parts for tokens in some for token in tokens])
            for some in parts:
                joined, data = [], []
                for tokens in some:
                    if end - start == 1:
                        self._learn(tokens)
                    joined += map(self.joined.__getitem__, tokens)
                    data += map(self.data.__getitem__, tokens)
                yield ",".join(joined), b"".join(data)

    def encode_all(self, texts: list[str]) -> Iterator[list[int]]:
        """The ids of each text."""
        for joined, _ in self.round_trips(texts):
            yield list(map(int, joined.split(","))) if joined else []

    def encode(self, text: str) -> list[int]:
        return next(self.encode_all([text]))

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def _codec_runner(shared, row: Callable) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = ForcedBoundaryCodec(shared.value)
        for batch in batches:
            yield row(codec, batch)

    return run


def encode_texts(spark: SparkSession, documents: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of each row."""

    def row(codec: ForcedBoundaryCodec, batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = list(codec.encode_all([text or "" for text in batch["text"].to_pylist()]))
        return pa.record_batch([batch["doc_id"], pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    shared = spark.sparkContext.broadcast(read_tokenizer(path))
    rows = documents.select(F.col("doc_id").cast("bigint"), "text")
    return rows.mapInArrow(_codec_runner(shared, row), "doc_id bigint, ids array<int>")


def decode_ids(spark: SparkSession, encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``text`` of each row of ids; null ids give an empty text."""

    def row(codec: ForcedBoundaryCodec, batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [codec.decode(ids or []) for ids in batch["ids"].to_pylist()]
        return pa.record_batch([batch["doc_id"], pa.array(texts, pa.string())], ["doc_id", "text"])

    shared = spark.sparkContext.broadcast(read_tokenizer(path))
    rows = encoded.select(F.col("doc_id").cast("bigint"), "ids")
    return rows.mapInArrow(_codec_runner(shared, row), "doc_id bigint, text string")


def round_trip(spark: SparkSession, documents: DataFrame, path: str) -> DataFrame:
    """Encode and decode in one pass: ``doc_id, n_tokens, ids_sha256, decoded_sha256``."""

    def sha(data: bytes) -> str:
        return hashlib.sha256(data).hexdigest()

    def row(codec: ForcedBoundaryCodec, batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, id_digests, text_digests = [], [], []
        for joined, data in codec.round_trips([text or "" for text in batch["text"].to_pylist()]):
            counts.append(joined.count(",") + 1 if joined else 0)
            id_digests.append(sha(joined.encode()))
            text_digests.append(sha(data.decode("utf-8", "replace").encode()))
        columns = [batch["doc_id"], pa.array(counts, pa.int64())]
        columns += [pa.array(id_digests, pa.string()), pa.array(text_digests, pa.string())]
        return pa.record_batch(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    shared = spark.sparkContext.broadcast(read_tokenizer(path))
    rows = documents.select(F.col("doc_id").cast("bigint"), "text")
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(_codec_runner(shared, row), schema)
