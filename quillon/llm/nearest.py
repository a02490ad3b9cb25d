"""Approximate nearest neighbours by a hash-prefix forest.

Rows are dealt into blocks by id, queries too. For every pair of a query block and a
data block one task builds the forest of its data: per tree a long hash string of each
vector (one bit per random hyperplane) and the strings in a sorted array. A query
descends in every tree to the rows that share its longest prefix, and then ascends in
all trees at once, one bit a step, until at least ``share`` of the block's distinct
vectors (or the number wanted) are candidates. Candidates are scored exactly and only
the best leave the task. Every row is in the index; nothing is sampled.

Equal vectors of a block are scored once and keep their smallest ids, which is all
that a tie can need, so a vector that a third of the rows share costs one candidate.

Nearness is cosine in double precision; ties go to the smaller id. Vectors that are
null, zero, or hold null or non-finite components, and rows with a null id, take no
part; vectors are compared to those of their own length. Of rows that share an id the
one with the fewest components stands, and of these the one with the smallest vector. A query with fewer candidates than ``k`` gets all.
An empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillon.operators.joins import lookup_join

TREES, BITS = 48, 24
#: Share of a block's distinct vectors that become candidates of a query at least.
SHARE = 0.4
DATA_BLOCK, QUERY_BLOCK = 16_384, 4_096


class Forest:
    """Sorted hash strings of the rows of ``vectors`` in each tree."""

    def __init__(self, vectors: np.ndarray, trees: int = TREES, bits: int = BITS) -> None:
        self.bits = bits
        planes = np.random.default_rng(vectors.shape[1])
        self.planes = planes.standard_normal((trees, vectors.shape[1], bits))
        self.rows = len(vectors)
        hashes = self._hash(vectors)
        self.order = np.argsort(hashes, axis=1, kind="stable")
        self.sorted = np.take_along_axis(hashes, self.order, 1)

    def _hash(self, vectors: np.ndarray) -> np.ndarray:
        weights = 1 << np.arange(self.bits - 1, -1, -1, dtype=np.int64)
        return np.stack([(vectors @ plane > 0) @ weights for plane in self.planes])

    def candidates(self, queries: np.ndarray, least: int) -> Iterator[np.ndarray]:
        """For each query a mask of the rows, ``least`` of them set if there are so many."""
        hashes = self._hash(queries)
        # Ends of the runs that share a prefix with a query, by level, tree and query.
        low, high = [], []
        for level in range(self.bits + 1):
            prefix = hashes >> (self.bits - level) << (self.bits - level)
            step = 1 << (self.bits - level)
            ends = [
                (np.searchsorted(s, p), np.searchsorted(s, p + step))
                for s, p in zip(self.sorted, prefix, strict=True)
            ]
            low.append([e[0] for e in ends])
            high.append([e[1] for e in ends])
        low, high = np.array(low), np.array(high)
        totals = (high - low).sum(1)
        for number in range(len(queries)):
            mask = np.zeros(self.rows, bool)
            # Fewer rows in all trees together than wanted cannot be enough.
            level = int(np.flatnonzero(totals[:, number] >= least).max(initial=0))
            while True:
                for tree in range(len(self.planes)):
                    run = slice(low[level, tree, number], high[level, tree, number])
                    mask[self.order[tree, run]] = True
                if level == 0 or np.count_nonzero(mask) >= least:
                    break
                level -= 1
            yield mask


def _as_arrays(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors, one row per id."""
    ids = frame["id"].to_numpy(np.int64)
    vectors = np.stack(frame["vector"].to_numpy()).astype(np.float64)
    order = np.lexsort((*vectors.T[::-1], ids))
    ids, vectors = ids[order], vectors[order]
    first = np.append(True, ids[1:] != ids[:-1])
    return ids[first], vectors[first]


def _nearest_in_block(
    queries: pd.DataFrame, data: pd.DataFrame, k: int, share: float
) -> pd.DataFrame:
    query_ids, query_vectors = _as_arrays(queries)
    ids, vectors = _as_arrays(data)
    distinct, group = np.unique(vectors, axis=0, return_inverse=True)
    in_groups = np.argsort(group, kind="stable")  # smallest ids first in each group
    starts = np.searchsorted(group[in_groups], np.arange(len(distinct) + 1))
    norms = np.linalg.norm(distinct, axis=1)
    asked, asked_group = np.unique(query_vectors, axis=0, return_inverse=True)
    least = min(len(distinct), max(k + 1, math.ceil(share * len(distinct))))
    forest = Forest(distinct)
    best = []
    for vector, mask in zip(asked, forest.candidates(asked, least), strict=True):
        rows = np.flatnonzero(mask)
        products = distinct[rows] @ vector
        rough = products / norms[rows]
        if len(rows) > k + 1:
            floor = np.partition(rough, -(k + 1))[-(k + 1)]
            rows = rows[rough >= floor - 1e-9 * abs(floor) - 1e-300]
        length = np.linalg.norm(vector)
        found = []
        for row in rows:
            score = float(np.dot(distinct[row], vector)) / float(norms[row] * length)
            found += [(-score, int(i)) for i in ids[in_groups[starts[row] : starts[row + 1]][: k + 1]]]
        best.append(sorted(found)[: k + 1])
    out = []
    for query_id, place in zip(query_ids.tolist(), asked_group, strict=True):
        out += [(query_id, i, -score) for score, i in [x for x in best[place] if x[1] != query_id][:k]]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``id, vector, size`` of the rows that take part."""
    rows = vectors.select(
        F.col(id_column).cast("bigint").alias("id"),
        F.col(vector_column).cast("array<double>").alias("vector"),
    )
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    nonzero = F.exists("vector", lambda x: x != 0)
    return rows.where(F.col("id").isNotNull() & finite & nonzero).withColumn("size", F.size("vector"))


def one_size(rows: DataFrame) -> DataFrame:
    """Of rows that share an id, those with the fewest components."""
    if rows.select("size").distinct().limit(2).count() < 2:
        return rows
    sizes = rows.groupBy("id").agg(F.min("size").alias("least"), F.max("size").alias("most"))
    several = sizes.where("least < most").select("id", "least")
    joined = lookup_join(rows, several, ["id"], "left", [F.xxhash64("vector")])
    return joined.where("least is null or size = least").drop("least")


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    share: float = SHARE,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    data_block: int = DATA_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for each query."""
    data = one_size(usable(vectors, id_column, vector_column))
    asked = one_size(usable(queries, id_column, vector_column))
    n_data = max(1, math.ceil(data.count() / data_block))
    n_asked = max(1, math.ceil(asked.count() / query_block))

    def dealt(rows: DataFrame, own: str, n: int, other: str, times: int) -> DataFrame:
        everywhere = F.explode(F.sequence(F.lit(0), F.lit(times - 1)))
        block = F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
        return rows.withColumn(own, block).withColumn(other, everywhere)

    def meet(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return _nearest_in_block(left, right, k, share)

    keys = ["query_block", "data_block", "size"]
    found = (
        dealt(asked, "query_block", n_asked, "data_block", n_data)
        .groupBy(*keys)
        .cogroup(dealt(data, "data_block", n_data, "query_block", n_asked).groupBy(*keys))
        .applyInPandas(meet, "query_id bigint, vec_id bigint, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
