"""Joins of many rows with one value per key, where a few keys may hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 1_000


def with_value(rows: DataFrame, values: DataFrame, key: str, total: int, size: str = "n") -> DataFrame:
    """Inner join of `rows` with `values`, which has one row per `key` and in `size` how many of
    the `total` rows have it; null keys are equal.

    Keys with more than a thousandth of all rows are at most a thousand, so their values are
    broadcast whatever the data; for the others no task gets more than that share of one key.
    """
    hot = F.col(size) * HOT_SHARE > total
    right = values.withColumnRenamed(key, "__key")
    same = F.col(key).eqNullSafe(F.col("__key"))
    common = F.broadcast(right.where(hot).drop(size))
    return (
        rows.join(common, same, "inner")
        .drop("__key")
        .unionByName(
            rows.join(common, same, "left_anti").join(right.where(~hot).drop(size), same, "inner").drop("__key")
        )
    )
