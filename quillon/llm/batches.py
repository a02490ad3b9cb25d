"""Small helpers for operators that see texts in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa


def text_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null counts as empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def each_batch(
    make: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]],
    most_bytes: int | None = None,
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function from one that turns a batch into batches.

    Batches of more than ``most_bytes`` are handed on in parts of about that size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = 1 if most_bytes is None else 1 + batch.nbytes // most_bytes
            rows = max(1, -(-batch.num_rows // parts))
            for start in range(0, batch.num_rows, rows):
                yield from make(batch.slice(start, rows))

    return run


def slices(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Cut a run of rows into ranges whose sizes add up to ``limit`` at most.

    A row larger than the limit gets a range of its own.
    """
    start, total = 0, 0
    for at, size in enumerate(sizes):
        if at > start and total + size > limit:
            yield start, at
            start, total = at, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)
