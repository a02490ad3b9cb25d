"""Removal of repeated byte strings by column-wise suffix ordering.

A byte goes when a string of ``LENGTH`` bytes that covers it also starts earlier: in a
document with a smaller id, or earlier in the same one. Strings are judged on the
input.

*Segments.* In every string of ``LENGTH`` bytes the ``ANCHOR``-byte piece with the
least hash, the first among equals, is its anchor, which depends on the string alone.
Neighbouring strings with one anchor form a segment. Equal strings so lie in segments
with equal anchors, and at the same distance from them. A segment whose anchor occurs
once in the corpus holds no repeated string; one that equals an earlier segment
consists of repeated strings. Only the first of each kind of segment whose anchor
also stands in other segments moves on, with its bytes.

*Columns.* These segments, aligned at their anchors, are the documents of a
multi-document construction: going from the last column to the first, each round
inserts one symbol of every segment, updating the order of the suffixes that start in
that column (the column of the collection's Burrows-Wheeler transform) and the common
prefixes of neighbours in it. Runs of neighbours with a common prefix of ``LENGTH``
or more are equal strings, and all but the first of each are repeats. The sequential
external files of the method are Spark's sorted shuffle files: a task reads its
anchors in order, some thousand segments at a time, and inserts in memory.

Segments are compared as they stream by in the order of anchor, content and place: only
the row that began the current content, and the first row of an anchor until a second
content shows, are held, so a common anchor needs no memory. An anchor with more than
``HOT`` different segments is not one group in the column step: its strings are grouped
by their own content, which combines before the shuffle, and those that occur more than
once are joined back with a salt.

Cases: null text counts as empty. Rows with a null ``doc_id`` lose nothing and give no
string to others. Of rows that share a ``doc_id`` the one with the largest text stands,
and one row is returned. Texts shorter than ``LENGTH`` keep all. An empty table gives an
empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.batches import each_batch, text_bytes
from quillon.operators.joins import lookup_join
from quillon.session import stored

LENGTH, ANCHOR = 100, 32
#: Starts of the anchor within a string, and so columns a string can start in.
STARTS = LENGTH - ANCHOR + 1
HOT = 200_000
#: Bytes of a long text looked at together, and segments ordered together.
PIECE, TOGETHER = 1 << 19, 40_000

_BASE = 0x9E3779B97F4A7C15


def _powers(base: int) -> np.ndarray:
    powers = np.full(PIECE + LENGTH, base, np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


_POWERS, _INVERSES = _powers(_BASE), _powers(pow(_BASE, -1, 2**64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def segments(data: bytes) -> tuple[np.ndarray, ...]:
    """Anchor hash, content hash, start, number of strings and anchor place of each segment."""
    found = []
    for begin in range(0, max(1, len(data) - LENGTH + 1), PIECE):
        piece = data[begin : begin + PIECE + LENGTH - 1]
        if len(piece) >= LENGTH:
            anchor, content, start, count, place = _segments(np.frombuffer(piece, np.uint8))
            found.append((anchor, content, start + begin, count, place))
    if not found:
        return tuple(np.empty(0, t) for t in (np.uint64, np.uint64, *[np.int64] * 3))
    return tuple(np.concatenate(column) for column in zip(*found, strict=True))


def _segments(seen: np.ndarray) -> tuple[np.ndarray, ...]:
    summed = np.zeros(len(seen) + 1, np.uint64)
    np.cumsum((seen + np.uint64(1)) * _POWERS[: len(seen)], out=summed[1:])
    pieces = len(seen) - ANCHOR + 1
    hashes = _mixed((summed[ANCHOR:] - summed[:-ANCHOR]) * _INVERSES[:pieces])
    # 44 bits of hash, then the place, so the first of equals is the least.
    least = (hashes >> np.uint64(20) << np.uint64(20)) | np.arange(pieces, dtype=np.uint64)
    width = 1
    while 2 * width <= STARTS:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < STARTS:
        least = np.minimum(least[: width - STARTS], least[STARTS - width :])
    anchors = (least & np.uint64((1 << 20) - 1)).astype(np.int64)
    starts = np.flatnonzero(np.append(True, anchors[1:] != anchors[:-1]))
    counts = np.diff(np.append(starts, len(anchors)))
    places = anchors[starts] - starts
    ends = starts + counts + LENGTH - 1
    content = (summed[ends] - summed[starts]) * _INVERSES[starts]
    content = _mixed(content ^ (counts * STARTS + places).astype(np.uint64) << np.uint64(48))
    return hashes[anchors[starts]], content, starts, counts, places


def _packed(start: np.ndarray, count: np.ndarray, place: np.ndarray) -> np.ndarray:
    return start << 14 | count << 7 | place


def _unpacked(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return at >> 14, at >> 7 & 127, at & 127


def _judge(anchor, content, doc, at) -> tuple[np.ndarray, np.ndarray]:
    """Of rows sorted by anchor, content, doc and place: first of its content, and repeat."""
    same = (anchor[1:] == anchor[:-1]) & (content[1:] == content[:-1])
    first = np.append(True, ~same)
    group = np.flatnonzero(first)[np.cumsum(first) - 1]
    return first, (doc != doc[group]) | (at != at[group])


SEGMENT = "anchor bigint, content bigint, doc_id bigint, at bigint, repeat boolean"
_NAMES = ["anchor", "content", "doc_id", "at", "repeat"]
_KEPT = ["anchor", "doc_id", "at", "repeat"]


def _segment_rows(documents: DataFrame) -> DataFrame:
    """All segments; those that repeat one of the same batch are marked already."""

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [segments(data) for data in text_bytes(batch["text"])]
        docs = np.repeat(batch["doc_id"].to_numpy(), [len(f[0]) for f in found])
        if not len(docs):
            return
        anchor, content, *places = (np.concatenate(c) for c in zip(*found, strict=True))
        at = _packed(*places)
        order = np.lexsort((at, docs, content, anchor))
        anchor, content, docs, at = (c[order] for c in (anchor, content, docs, at))
        _, repeat = _judge(anchor, content, docs, at)
        columns = (anchor.view(np.int64), content.view(np.int64), docs, at, repeat)
        yield pa.record_batch([pa.array(c) for c in columns], _NAMES)

    return documents.select("doc_id", "text").mapInArrow(each_batch(make), SEGMENT)


def _whole_anchors(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.Table]:
    """Tables of ``least`` rows or more that end where an anchor ends; rows come sorted."""
    waiting: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if batch.num_rows:
            waiting.append(batch)
            rows += batch.num_rows
        if rows >= least:
            table = pa.Table.from_batches(waiting)
            anchors = table["anchor"].to_numpy()
            cut = int(np.searchsorted(anchors, anchors[-1]))
            if cut:
                yield table.slice(0, cut)
                waiting, rows = table.slice(cut).combine_chunks().to_batches(), len(table) - cut
    if waiting:
        yield pa.Table.from_batches(waiting)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What ``_compare_segments`` gives, of sorted rows; holds one batch and two rows."""
    # The row that began the last content, and whether it waits for a second content.
    began: tuple[int, int, int, int] | None = None
    waits = False
    for batch in batches:
        known = batch["repeat"].to_numpy(zero_copy_only=False)
        if known.any():
            repeats = batch.filter(pa.array(known))
            yield pa.record_batch([repeats[name] for name in _KEPT], _KEPT)
            batch = batch.filter(pa.array(~known))
        if not batch.num_rows:
            continue
        columns = [batch[name].to_numpy() for name in _NAMES[:4]]
        if began is not None:
            columns = [np.append(np.int64(b), c) for b, c in zip(began, columns, strict=True)]
        anchor, content, doc, at = columns
        first, repeat = _judge(anchor, content, doc, at)
        starts = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
        several = np.add.reduceat(first.astype(np.int64), starts) > 1
        if began is not None and not waits:
            several[0] = True
        wanted = repeat | (first & np.repeat(several, np.diff(np.append(starts, len(anchor)))))
        if began is not None and not waits:
            wanted[0] = False  # handed on before
        last = np.flatnonzero(first)[-1]
        began, waits = tuple(int(c[last]) for c in columns), not several[-1]
        if wanted.any():
            yield pa.record_batch(
                [pa.array(c[wanted]) for c in (anchor, doc, at, repeat)], _KEPT
            )


def _compare_segments(rows: DataFrame) -> DataFrame:
    """Repeated segments, and (``repeat`` false) firsts whose anchor has other segments too."""

    # What a batch has found to be a repeat needs no comparison, and goes anywhere.
    place = F.when(F.col("repeat"), F.xxhash64("doc_id", "at")).otherwise(F.col("anchor"))
    ordered = rows.repartition(place).sortWithinPartitions("anchor", "content", "doc_id", "at")
    return ordered.mapInArrow(
        _compared, "anchor bigint, doc_id bigint, at bigint, repeat boolean"
    )


def _with_bytes(firsts: DataFrame, documents: DataFrame) -> DataFrame:
    """``anchor, doc_id, at, piece``: the segments with their bytes."""
    by_document = firsts.groupBy("doc_id").agg(F.collect_list(F.struct("anchor", "at")).alias("found"))
    texts = lookup_join(
        documents.select("doc_id", "text"), firsts.select("doc_id").distinct(), ["doc_id"], "left_semi"
    )

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lists = batch["found"]
        sizes = lists.value_lengths().to_numpy()
        flat = lists.flatten()
        at = flat.field("at").to_numpy()
        start, count, _ = _unpacked(at)
        owners = np.repeat(np.arange(batch.num_rows), sizes)
        data = text_bytes(batch["text"])
        ends = start + count + LENGTH - 1
        pieces = [
            data[o][s:e] for o, s, e in zip(owners.tolist(), start.tolist(), ends.tolist(), strict=True)
        ]
        docs = batch["doc_id"].to_numpy()[owners]
        columns = [flat.field("anchor"), pa.array(docs), pa.array(at), pa.array(pieces, pa.binary())]
        yield pa.record_batch(columns, ["anchor", "doc_id", "at", "piece"])

    return texts.join(by_document, "doc_id").mapInArrow(
        each_batch(make), "anchor bigint, doc_id bigint, at bigint, piece binary"
    )


def repeated_columns(
    group: np.ndarray, rank: np.ndarray, place: np.ndarray, count: np.ndarray, pieces: list[bytes]
) -> np.ndarray:
    """Which strings of each segment are repeats: by segment and starting column.

    ``group`` is sorted; ``rank`` orders the segments of a group by where they stand.
    Column ``STARTS - 1`` is that of the anchor's first byte.
    """
    rows, width = len(group), STARTS - 1 + LENGTH
    begin = STARTS - 1 - place
    end = begin + count + LENGTH - 1
    table = np.zeros((rows, width), np.uint8)
    inside = np.arange(width) >= begin[:, None]
    inside &= np.arange(width) < end[:, None]
    table[inside] = np.frombuffer(b"".join(pieces), np.uint8)
    table, inside = np.ascontiguousarray(table.T), np.ascontiguousarray(inside.T)
    repeat = np.zeros((STARTS, rows), bool)

    order = np.arange(rows)
    common = np.zeros(rows, np.int64)  # with the neighbour before, in the last column's order
    for column in range(width - 1, -1, -1):
        symbol = group * 256 + table[column][order]
        moved = np.argsort(symbol, kind="stable")
        symbol = symbol[moved]
        # The common prefix of new neighbours is the least between their old places.
        low, high = moved[:-1] + 1, moved[1:] + 1
        prefix = common[moved[1:]]
        same = symbol[1:] == symbol[:-1]
        far = np.flatnonzero(same & (high - low > 1))
        if len(far):
            bounds = np.stack((low[far], high[far]), 1).ravel()
            padded = np.append(common, 0)
            prefix[far] = np.minimum.reduceat(padded, bounds)[::2]
        order = order[moved]
        here = inside[column][order]
        common = np.append(0, np.where(same & here[1:] & here[:-1], prefix + 1, 0))
        if column < STARTS:
            equal = common >= LENGTH
            if equal.any():
                starts = np.flatnonzero(~equal)
                ranks = rank[order]
                least = np.repeat(
                    np.minimum.reduceat(ranks, starts), np.diff(np.append(starts, rows))
                )
                repeat[column, order] = ranks != least
    return repeat.T


def _runs(repeat: np.ndarray, doc: np.ndarray, origin: np.ndarray) -> pa.RecordBatch:
    """``doc_id, start, n``: runs of repeated strings; ``origin`` is where column 0 stands."""
    edges = np.diff(np.pad(repeat, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, start = np.nonzero(edges == 1)
    _, end = np.nonzero(edges == -1)
    columns = (doc[row], origin[row] + start, end - start)
    return pa.record_batch([pa.array(c) for c in columns], ["doc_id", "start", "n"])


RUN = "doc_id bigint, start bigint, n bigint"


def _order_columns(rows: DataFrame) -> DataFrame:
    """Runs of repeated strings among segments that share an anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_anchors(batches, TOGETHER):
            anchor, doc, at = (table[n].to_numpy() for n in ("anchor", "doc_id", "at"))
            start, count, place = _unpacked(at)
            group = np.cumsum(np.append(0, anchor[1:] != anchor[:-1]))
            standing = np.lexsort((start + place, doc))
            rank = np.empty(len(doc), np.int64)
            changed = np.append(
                True,
                (np.diff(doc[standing]) != 0) | (np.diff((start + place)[standing]) != 0),
            )
            rank[standing] = np.cumsum(changed)
            repeat = repeated_columns(group, rank, place, count, table["piece"].to_pylist())
            yield _runs(repeat, doc, start + place - (STARTS - 1))

    ordered = rows.repartition("anchor").sortWithinPartitions("anchor")
    return ordered.mapInArrow(run, RUN)


def _group_strings(rows: DataFrame) -> DataFrame:
    """The same for anchors of very many segments: every string by its own content."""

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        strings, docs, starts = [], [], []
        for doc, at, piece in zip(
            batch["doc_id"].to_pylist(), batch["at"].to_pylist(), batch["piece"].to_pylist(), strict=True
        ):
            start = at >> 14
            for shift in range(len(piece) - LENGTH + 1):
                strings.append(piece[shift : shift + LENGTH])
                docs.append(doc)
                starts.append(start + shift)
        columns = [pa.array(strings, pa.binary()), pa.array(docs, pa.int64()), pa.array(starts, pa.int64())]
        yield pa.record_batch(columns, ["string", "doc_id", "start"])

    strings = rows.mapInArrow(each_batch(make), "string binary, doc_id bigint, start bigint")
    several = stored(
        strings.groupBy("string")
        .agg(F.min(F.struct("doc_id", "start")).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n"),
        "strings",
    )
    later = F.struct("doc_id", "start") != F.col("first")
    spread = [F.col("doc_id"), F.col("start")]
    return (
        lookup_join(strings, several, ["string"], "inner", spread)
        .where(later)
        .select("doc_id", "start", F.lit(1).cast("bigint").alias("n"))
    )


def _one_row_per_id(documents: DataFrame) -> DataFrame:
    """``doc_id, text`` with one row for each id that is not null."""
    rows = documents.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    named = rows.where("doc_id is not null")
    repeated = stored(named.groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    if repeated.isEmpty():
        return named
    several = named.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.max("text").alias("text"))
    return named.join(repeated, "doc_id", "left_anti").unionByName(several)


def repeated_runs(documents: DataFrame, hot: int = HOT) -> DataFrame:
    """``doc_id, start, n``: runs of ``n`` neighbouring strings that start earlier elsewhere."""
    compared = stored(_compare_segments(_segment_rows(documents)), "segments")
    whole = compared.where("repeat").select(
        "doc_id",
        F.shiftright("at", 14).alias("start"),
        F.shiftright("at", 7).bitwiseAND(127).alias("n"),
    )
    firsts = compared.where("not repeat").select("anchor", "doc_id", "at")
    pieces = _with_bytes(firsts, documents)
    busy = stored(firsts.groupBy("anchor").count().where(F.col("count") > hot).select("anchor"), "busy")
    if busy.isEmpty():
        return whole.unionByName(_order_columns(pieces))
    pieces = stored(pieces, "pieces")
    usual = lookup_join(pieces, busy, ["anchor"], "left_anti", [F.col("doc_id")])
    others = lookup_join(pieces, busy, ["anchor"], "left_semi", [F.col("doc_id")])
    return whole.unionByName(_order_columns(usual)).unionByName(_group_strings(others))


def _spans(starts: np.ndarray, counts: np.ndarray) -> list[tuple[int, int]]:
    """Maximal covered ranges of runs of strings."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], (starts + counts + LENGTH - 1)[order]
    reach = np.maximum.accumulate(ends)
    first = np.flatnonzero(np.append(True, starts[1:] > reach[:-1]))
    last = np.append(first[1:] - 1, len(starts) - 1)
    return list(zip(starts[first].tolist(), reach[last].tolist(), strict=True))


def removed_repeats(documents: DataFrame, hot: int = HOT) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans`` of each row.

    ``spans`` lists the removed byte ranges, the end exclusive.
    """
    named = _one_row_per_id(documents)
    runs = stored(repeated_runs(named, hot), "runs")
    touched = runs.select("doc_id").distinct()
    by_document = runs.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("runs"))

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out = []
        for data, runs in zip(text_bytes(batch["text"]), batch["runs"], strict=True):
            flat = runs.values
            spans = _spans(flat.field("start").to_numpy(), flat.field("n").to_numpy())
            kept, at = hashlib.sha256(), 0
            for start, end in spans:
                kept.update(data[at:start])
                at = end
            kept.update(data[at:])
            removed = sum(end - start for start, end in spans)
            pairs = [{"start": start, "end": end} for start, end in spans]
            out.append((len(data), removed, len(spans), kept.hexdigest(), pairs))
        pair = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pair)]
        columns = [pa.array([o[i] for o in out], kind) for i, kind in enumerate(kinds)]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
        yield pa.record_batch([batch["doc_id"], *columns], names)

    schema = (
        "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string,"
        " spans array<struct<start: bigint, end: bigint>>"
    )
    cut = (
        lookup_join(named, touched, ["doc_id"], "left_semi")
        .join(by_document, "doc_id")
        .mapInArrow(each_batch(make), schema)
    )
    nameless = documents.where("doc_id is null").select(
        F.lit(None).cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    untouched = lookup_join(named, touched, ["doc_id"], "left_anti").unionByName(nameless)
    whole = untouched.select(
        "doc_id",
        F.octet_length("text").cast("bigint").alias("n_bytes"),
        F.lit(0).cast("bigint").alias("n_removed"),
        F.lit(0).cast("bigint").alias("n_spans"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
        F.array().cast("array<struct<start: bigint, end: bigint>>").alias("spans"),
    )
    return cut.unionByName(whole)
