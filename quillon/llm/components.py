"""Connected components of a link table, by alternating large and small stars.

Every round replaces links by links to the smallest neighbour. Before it, each task joins
the ``LINKS_TOGETHER`` links or so that it reads on its own, which leaves at most one link
per node and task; when a single task has so seen them all, no round is needed. Rounds are written to the shared folder, so no lineage piles up and a lost
executor costs one round. The smallest neighbour of a node is found by an aggregation
that combines before its shuffle, so a node with very many links is no unbounded group.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.session import stored

#: Links that a task joins at most; their number sets the number of tasks.
LINKS_TOGETHER = 500_000


def _forest(links: Iterator[tuple[int, int]]) -> dict[int, int]:
    """Each node that is not the smallest it is connected with -> that one."""
    parent: dict[int, int] = {}

    def root(node: int) -> int:
        while (up := parent.get(node, node)) != node:
            parent[node] = node = parent.get(up, up)
        return node

    for one, two in links:
        low, high = sorted((root(one), root(two)))
        if low != high:
            parent[high] = low
    return {node: root(node) for node in list(parent)}


def _joined_in_place(links: DataFrame) -> DataFrame:
    """Links ``u > v`` with the same components, made from each task's own links."""
    most = 4 * LINKS_TOGETHER  # tasks differ in size; past this, one goes on in parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def joined() -> pa.RecordBatch:
            rows = pa.Table.from_batches(waiting)
            found = _forest(zip(rows["u"].to_pylist(), rows["v"].to_pylist(), strict=True))
            pairs = [(u, v) for u, v in found.items() if u != v]
            columns = [pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)]
            return pa.record_batch(columns, ["u", "v"])

        for batch in batches:
            waiting.append(batch)
            if sum(b.num_rows for b in waiting) >= most:
                yield joined()
                waiting = []
        if waiting:
            yield joined()

    return links.select("u", "v").mapInArrow(run, "u bigint, v bigint")


def _with_least(links: DataFrame) -> DataFrame:
    """``links`` (u, v) with ``m``, the least of u and its neighbours."""
    least = links.groupBy("u").agg(F.min("v").alias("least"))
    return links.join(least, "u").withColumn("m", F.least("u", "least"))


def _large_star(links: DataFrame) -> DataFrame:
    """From links ``u > v``; the larger neighbours of each node go to its least."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    found = _with_least(both).where("v > u")
    return found.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """From links ``u > v``; the smaller neighbours of each node, and it, go to the least."""
    starred = _with_least(links)
    moved = starred.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = starred.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).distinct()


def _digest(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first())


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node of ``links`` (u, v) that is not the smallest of
    its component."""
    current = stored(links.select("u", "v").distinct(), "links")
    seen = _digest(current)
    while True:
        tasks = max(1, -(-seen[0] // LINKS_TOGETHER))
        joined = _joined_in_place(current.coalesce(tasks))
        if tasks == 1:  # it has seen every link
            current = stored(joined, "links")
            break
        current = stored(_small_star(_large_star(joined.distinct())), "links")
        now = _digest(current)
        if now == seen:
            break
        seen = now
    return current.select(F.col("u").alias("node"), F.col("v").alias("component"))
