"""Joins that hold up when one key carries a large share of the rows."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.session import ship_package

# A side is broadcast only below both limits.
MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 128 * 1024 * 1024
# Ways a key is split when the other side is too large to broadcast.
SALTS = 16
# A name that no caller's column has.
_SALT = "__quillon_salt"


def is_small(
    df: DataFrame,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> bool:
    """Measure ``df`` and say whether it may be broadcast.

    Reads ``max_rows + 1`` rows at most and brings back one row of totals.
    """
    width = F.lit(0)
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType | T.BinaryType):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, T.ArrayType):
            width = width + 16 * F.greatest(F.size(field.name), F.lit(0))
        width = width + 8
    seen = (
        df.select(width.cast("bigint").alias("width"))
        .limit(max_rows + 1)
        .agg(F.count("*").alias("n"), F.coalesce(F.sum("width"), F.lit(0)).alias("size"))
        .first()
    )
    return seen["n"] <= max_rows and seen["size"] <= max_bytes


def lookup_join(
    big: DataFrame,
    side: DataFrame,
    on: list[str],
    how: str = "inner",
    spread_by: list[Column] | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Join a corpus-sized table with a side table.

    The side is broadcast when ``small`` (measured if not given), and ``big`` is
    then not shuffled. Otherwise both are shuffled on ``on`` plus a salt: the big
    side takes its salt from ``spread_by``, the side is repeated once per salt, so
    no key lands in one task whole. ``how`` may be any type that keeps ``big`` on
    the outside (inner, left, left_semi, left_anti).
    """
    if small is None:
        small = is_small(side)
    if small:
        return big.join(F.broadcast(side), on, how)
    if not spread_by:
        return big.join(side, on, how)
    salted = big.withColumn(_SALT, F.pmod(F.xxhash64(*spread_by), F.lit(SALTS)))
    repeated = side.withColumn(
        _SALT, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint")))
    )
    return salted.join(repeated, [*on, _SALT], how).drop(_SALT)


def can_be_held(side: DataFrame) -> bool:
    """Whether every task may keep ``side`` as a dictionary in Python: what may be broadcast."""
    return is_small(side)


def held_lookup(spark: SparkSession, table: dict[str, str]) -> Callable[[Column], Column]:
    """For an array of keys the array of their values in ``table``, null where it has none.

    Null and empty arrays give null. Nothing is exploded or shuffled; each distinct key of a batch is looked up once.
    """
    ship_package(spark)
    shared = spark.sparkContext.broadcast(table)

    @F.arrow_udf("array<string>")
    def looked_up(keys: pa.Array) -> pa.Array:
        flat = keys.flatten().dictionary_encode()
        values = pa.array([shared.value.get(k) for k in flat.dictionary.to_pylist()], pa.string())
        sizes = keys.value_lengths().fill_null(0).to_numpy()
        return list_of(sizes, values.take(flat.indices))

    return looked_up


def list_of(sizes: np.ndarray, flat: pa.Array) -> pa.Array:
    """``flat`` cut into lists of ``sizes``; null where a size is 0."""
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), flat, mask=pa.array(sizes == 0))
