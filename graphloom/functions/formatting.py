"""Exact text forms of results."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNREACHED_LEVEL = 2**63 - 1  # fixed value: printed for vertices a search doesn't reach
UNREACHED_DISTANCE = "infinity"  # fixed value: likewise for distances


def format_level(level: Column) -> Column:
    return F.coalesce(level, F.lit(UNREACHED_LEVEL)).cast("string")


def format_scientific(x: Column) -> Column:
    """Fifteen decimals and a two-digit exponent, rounded from the exact binary value.

    The JVM's formatter rounds the shortest decimal that reads back as the number instead, which differs in the last
    place for about half of all numbers; so this one column goes through Python in Arrow batches.
    """

    def digits(batch: pa.Array) -> pa.Array:
        return pa.array([None if v is None else f"{v:.15e}" for v in batch.to_pylist()], pa.string())

    return F.arrow_udf(digits, "string")(x)


def format_distance(distance: Column) -> Column:
    return F.when(distance.isNull(), UNREACHED_DISTANCE).otherwise(format_scientific(distance))


FORMATS = {
    "level": format_level,
    "distance": format_distance,
    "rank": format_scientific,
    "lcc": format_scientific,
    "component": lambda c: c.cast("string"),
    "label": lambda c: c.cast("string"),
}


def result_lines(result: DataFrame, value: str) -> DataFrame:
    """(id, line): `<id> <value>` of each vertex in the form of its result column."""
    return result.select("id", F.concat_ws(" ", F.col("id").cast("string"), FORMATS[value](F.col(value))).alias("line"))
