"""Nearest vectors, exactly, in cells around pivots that are skipped by their bounds.

Vectors of length 1 lie on a sphere, where angles keep the triangle inequality. Every
vector belongs to its nearest pivot; a pivot's vectors are cut into *cells* of bounded
size, each with the least and the largest angle to the pivot. A query at angle ``a`` of the
pivot is at least ``max(0, a - largest, least - a)`` away from all vectors of a cell, so
the cell's cosines are bounded before any is computed.

1. Each query is compared with one cell of its own pivot. The ``k``-th best cosine
   found there is its threshold.
2. Of all other cells it visits those whose bound reaches the threshold. Queries go in
   bundles and cells in slabs, both of bounded size and along a chain of near pivots, so that
   those of a bundle visit much the same slabs. A bundle and a slab meet in a task of their
   own, where each query is compared with those cells that it must visit: vectors are sent
   once per pair of bundle and slab, and not with every visit.

Nothing is approximate: a cell is skipped only if no vector in it could be among the ``k``
best, ties included. How many cells that are depends on how much the vectors cluster.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.operators.joins import is_small, lookup_join
from quillon.operators.numbering import top_per_group
from quillon.operators.vectors import DECIMALS, _nearest_of, block_nearest, matrix, nearest_vectors, unit
from quillon.session import stored

CELL_ROWS = 2048
# Vectors of a slab, and queries of a bundle: what a task of the second step holds of each.
SLAB_ROWS = 16_384
# Pivots are the only vectors on the driver: this many at most, whatever the table.
MAX_PIVOTS = 1024
# Cosines are compared rounded: half a unit for each of two of them, and floating error.
_MARGIN = 10.0**-DECIMALS + 1e-7


def usable(df: DataFrame) -> DataFrame:
    """``name, vector`` of rows whose vector has only finite components and a length."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.select("name", F.col("vector").cast("array<double>").alias("vector"))
    return rows.where(finite & F.exists("vector", lambda x: x != 0) & F.col("name").isNotNull())


def _choose_pivots(vectors: DataFrame, rows: int, pivots: int | None) -> np.ndarray:
    """Some of the vectors, chosen by a hash of their components: equal ones count once."""
    wanted = pivots or int(np.ceil(np.sqrt(rows)))
    chosen = (
        vectors.select("vector", F.xxhash64("vector").alias("h"))
        .dropDuplicates(["h"])
        .orderBy("h")
        .limit(min(wanted, MAX_PIVOTS))
        .toPandas()
    )
    return matrix(chosen["vector"])


def _angles(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(rows @ pivots.T, -1.0, 1.0))


def _assigner(shared):
    def assign(batches):
        for batch in batches:
            if len(batch):
                angles = _angles(matrix(batch["vector"]), shared.value)
                nearest = angles.argmin(axis=1)
                yield batch.assign(
                    pivot=nearest.astype(np.int32), angle=angles[np.arange(len(batch)), nearest]
                )

    return assign


def _in_cells(df: DataFrame, shared, name_type: str, cell_rows: int) -> tuple[DataFrame, DataFrame]:
    """Rows with ``pivot, part, angle``, and the cells ``pivot, part, least, most, rows``.

    A pivot's rows are cut by a hash of the name into as many parts as they need.
    """
    schema = f"name {name_type}, vector array<double>, pivot int, angle double"
    assigned = stored(df.mapInPandas(_assigner(shared), schema), "assigned")
    sizes = assigned.groupBy("pivot").agg(F.ceil(F.count("*") / cell_rows).alias("parts"))
    # No more rows than pivots.
    part = F.pmod(F.xxhash64("name"), F.col("parts")).cast("int").alias("part")
    placed = assigned.join(F.broadcast(sizes), "pivot").select(*assigned.columns, part)
    cells = placed.groupBy("pivot", "part").agg(
        F.min("angle").alias("least"), F.max("angle").alias("most"), F.count("*").alias("rows")
    )
    return placed, cells


def _meet(queries: DataFrame, vectors: DataFrame, k: int, schema: str) -> DataFrame:
    """The ``k`` best per query and visited cell; both sides have ``group, cell``."""
    sides = ["name", "vector", "group", "cell"]
    both = queries.select(*sides, F.lit(True).alias("asked")).unionByName(
        vectors.select(*sides, F.lit(False).alias("asked"))
    )
    return both.groupBy("group", "cell").applyInPandas(block_nearest(k), schema)


def _chain(pivots: np.ndarray) -> np.ndarray:
    """The pivots' numbers from each to the nearest one not yet taken."""
    left, order = np.ones(len(pivots), dtype=bool), [0]
    left[0] = False
    while left.any():
        near = np.where(left, pivots @ pivots[order[-1]], -np.inf).argmax()
        order.append(int(near))
        left[near] = False
    return np.array(order)


def _cut(rows: np.ndarray, most: int) -> np.ndarray:
    """Numbers of consecutive parts of no more than ``most`` rows, or of a single entry."""
    numbers, room, number = [], most, 0
    for n in rows.tolist():
        if n > room and room < most:
            number, room = number + 1, most
        numbers.append(number)
        room -= n
    return np.array(numbers, dtype=np.int64)


def _bundles(asked: DataFrame, place: np.ndarray, slab_rows: int) -> DataFrame:
    """``pivot, bundle, parts``: the first bundle of a pivot's queries, and how many it has."""
    counts = asked.groupBy("pivot").count().toPandas()  # a row per pivot
    counts = counts.iloc[np.argsort(place[counts["pivot"].to_numpy()])]
    parts = np.maximum(1, -(-counts["count"].to_numpy() // slab_rows))
    first = _cut(counts["count"].to_numpy(), slab_rows)
    before = np.concatenate([[0], np.cumsum(parts - 1)[:-1]]) if len(parts) else parts
    rows = pd.DataFrame({"pivot": counts["pivot"], "bundle": first + before, "parts": parts})
    return asked.sparkSession.createDataFrame(rows.astype("int64"), "pivot bigint, bundle bigint, parts bigint")


def _reached(angles: np.ndarray, cells: pd.DataFrame, threshold: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Which cells each query must visit, beyond the one already seen."""
    angles = angles[:, cells["pivot"].to_numpy()]
    away = np.maximum(angles - cells["most"].to_numpy(), cells["least"].to_numpy() - angles)
    reach = np.cos(np.maximum(0.0, away)) + _MARGIN >= threshold[:, None]
    return reach & (cells["cell"].to_numpy()[None, :] != seen[:, None])


def _visitor(shared, cells: pd.DataFrame):
    """Names of queries with the cells that they must visit."""

    def visit(batches):
        for name, _, query, cell in _visited(batches, shared, cells):
            yield pd.DataFrame({"name": name[query], "cell": cells["cell"].to_numpy()[cell]})

    return visit


def _meeting(shared, cells: pd.DataFrame):
    """Bundles of queries with the slabs that one of them must visit, once for each batch."""

    def meet(batches):
        for _, bundle, query, cell in _visited(batches, shared, cells):
            pairs = {"bundle": bundle[query], "slab": cells["slab"].to_numpy()[cell]}
            yield pd.DataFrame(pairs).drop_duplicates()

    return meet


def _visited(batches, shared, cells: pd.DataFrame):
    for batch in batches:
        for at in range(0, len(batch), 256):
            rows = batch.iloc[at : at + 256]
            angles = _angles(matrix(rows["vector"]), shared.value)
            reach = _reached(angles, cells, rows["threshold"].to_numpy(), rows["seen"].to_numpy())
            yield rows["name"].to_numpy(), rows["bundle"].to_numpy(), *np.nonzero(reach)


def _comparer(shared, cells: pd.DataFrame, k: int):
    """Local part: the ``k`` best of a slab for each query of a bundle, by the cells it visits."""

    def compare(pair: pd.DataFrame) -> pd.DataFrame:
        queries, rows = pair[pair["asked"]], pair[~pair["asked"]]
        best = pd.DataFrame({"term": [], "neighbour": [], "similarity": []})
        if not (len(queries) and len(rows)):
            return best
        names, asked = queries["name"].to_numpy(), matrix(queries["vector"])
        angles = _angles(asked, shared.value)
        limits = queries["threshold"].to_numpy(), queries["seen"].to_numpy()
        for number, cell in rows.groupby("cell"):
            reach = _reached(angles, cells.iloc[[number]], *limits)[:, 0]
            if reach.any():
                found = _nearest_of(
                    names[reach], asked[reach], cell["name"].to_numpy(), matrix(cell["vector"]), k
                )
                both = found if not len(best) else pd.concat([best, found], ignore_index=True)
                both = both.sort_values(["term", "similarity", "neighbour"], ascending=[True, False, True])
                best = both.groupby("term", sort=False).head(k)
        return best

    return compare


def nearest_by_pivots(
    queries: DataFrame,
    vectors: DataFrame,
    k: int = 3,
    pivots: int | None = None,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """``term, neighbour, similarity, rank``: the ``k`` nearest of each query by cosine.

    Both sides have ``name, vector`` (further columns are ignored), all of one length; names
    are distinct. The query's own name is left out; similarities are compared rounded and ties
    go to the lower name. Vectors that are null, zero, or hold null or non-finite
    components take no part, and with no vectors there are no rows. A query with fewer than
    ``k`` others gets all of them. The number of pivots is the root of the number of vectors
    if not given, and ``MAX_PIVOTS`` at most.
    """
    return _search(queries, vectors, k, pivots, cell_rows, SLAB_ROWS)[0]


def visits(
    queries: DataFrame,
    vectors: DataFrame,
    k: int = 3,
    pivots: int | None = None,
    cell_rows: int = CELL_ROWS,
) -> tuple[int, int]:
    """How many (query, cell) pairs the second step visits, and how many there are."""
    _, visiting, n_queries, n_cells = _search(queries, vectors, k, pivots, cell_rows, SLAB_ROWS)
    return (0 if visiting is None else visiting.count()), n_queries * n_cells


def _search(queries, vectors, k, pivots, cell_rows, slab_rows):
    spark = queries.sparkSession
    kind = vectors.schema["name"].dataType
    name_type = kind.simpleString()
    schema = f"term {name_type}, neighbour {name_type}, similarity double"
    order = [F.desc("similarity"), F.asc("neighbour")]
    vectors = stored(unit(usable(vectors)), "units")
    queries = unit(usable(queries))
    n_vectors = vectors.count()
    if not n_vectors:
        none = spark.createDataFrame([], T.StructType.fromDDL(schema))
        return top_per_group(none, ["term"], order, k, "rank"), None, 0, 0
    shared = spark.sparkContext.broadcast(_choose_pivots(vectors, n_vectors, pivots))
    placed, cells = _in_cells(vectors, shared, name_type, cell_rows)
    # One row per cell: vectors / cell_rows + pivots of them. A table of cells too large for
    # every task (some billion vectors) leaves the search of all blocks.
    cells = stored(cells, "cells")
    if not is_small(cells):
        return nearest_vectors(queries, vectors, k), None, 0, 0
    table = cells.orderBy("pivot", "part").toPandas()
    table["cell"] = np.arange(len(table))
    numbers = spark.createDataFrame(table[["pivot", "part", "cell", "rows"]])
    placed = placed.join(F.broadcast(numbers.drop("rows")), ["pivot", "part"])
    # Cut like the vectors, into the groups.
    asked, _ = _in_cells(queries, shared, name_type, cell_rows)
    # A query first meets the fullest cell of its pivot (any other where there is none).
    fullest = table.sort_values(["rows", "cell"]).groupby("pivot", as_index=False).last()
    first = spark.createDataFrame(fullest[["pivot", "cell"]])
    group = F.concat_ws("-", "pivot", "part").alias("group")
    homed = asked.join(F.broadcast(first), "pivot", "left").select(
        "name", "vector", "pivot", group, F.coalesce("cell", F.lit(0)).cast("bigint").alias("cell")
    )
    homed = stored(homed, "homed")
    met = stored(_meet(homed, _sent(placed, homed), k, schema), "met")
    reached = top_per_group(met, ["term"], order, k, "rank").where(F.col("rank") == k)
    threshold = reached.select(F.col("term").alias("name"), F.col("similarity").alias("threshold"))
    bounded = homed.withColumnRenamed("cell", "seen").join(threshold, "name", "left")
    bounded = bounded.fillna(-2.0, subset=["threshold"])
    place = np.empty(len(shared.value), dtype=np.int64)
    place[_chain(shared.value)] = np.arange(len(shared.value))
    along = np.argsort(place[table["pivot"].to_numpy()], kind="stable")
    table.loc[along, "slab"] = _cut(table["rows"].to_numpy()[along], slab_rows)
    table["slab"] = table["slab"].astype("int64")
    bundles = F.broadcast(_bundles(bounded, place, slab_rows))
    bundle = (F.col("bundle") + F.pmod(F.xxhash64("name"), F.col("parts"))).alias("bundle")
    bounded = bounded.join(bundles, "pivot").select("name", "vector", "seen", "threshold", bundle)
    bounded = stored(bounded, "bounded")
    pairs = bounded.mapInPandas(_meeting(shared, table), "bundle bigint, slab bigint").distinct()
    pairs = stored(pairs, "pairs")
    slabs = F.broadcast(spark.createDataFrame(table[["cell", "slab"]]))
    asking = lookup_join(bounded, pairs, ["bundle"], spread_by=[F.xxhash64("name")]).withColumn(
        "cell", F.lit(-1).cast("bigint")
    )
    slab = placed.select("name", "vector", F.col("cell").cast("bigint")).join(slabs, "cell")
    given = lookup_join(slab, pairs, ["slab"], spread_by=[F.xxhash64("name")]).select(
        "*", F.lit(-1).cast("bigint").alias("seen"), F.lit(0.0).alias("threshold")
    )
    both = asking.withColumn("asked", F.lit(True)).unionByName(given.withColumn("asked", F.lit(False)))
    compared = both.groupBy("bundle", "slab").applyInPandas(_comparer(shared, table, k), schema)
    best = top_per_group(met.unionByName(compared), ["term"], order, k, "rank")
    visiting = bounded.mapInPandas(_visitor(shared, table), f"name {name_type}, cell bigint")
    return best, visiting, homed.count(), len(table)


def _sent(placed: DataFrame, visiting: DataFrame) -> DataFrame:
    """The vectors of each cell, once for each group of queries that visits it."""
    pairs = visiting.select("group", "cell").distinct()
    rows = placed.select("name", "vector", F.col("cell").cast("bigint").alias("cell"))
    return lookup_join(rows, pairs, ["cell"], spread_by=[F.xxhash64("name")])
