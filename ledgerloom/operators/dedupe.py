"""Union, distinct and keep-one-per-key."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def union_aligned(frames: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL by column name; a column absent from one frame is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def keep_first(df: DataFrame, keys: Iterable[str], order_by: Iterable[Column | str]) -> DataFrame:
    """One row per key, the first in the given order.

    ``row_number() = 1`` is planned as a window group limit: each map task
    sends at most one row per key, so a hot key does not meet in one task.
    """
    place = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_place", F.row_number().over(place)).filter("_place = 1").drop("_place")


def keep_last(df: DataFrame, keys: Iterable[str], order_by: Iterable[str]) -> DataFrame:
    """One row per key, the last in the given ascending order."""
    return keep_first(df, keys, [F.col(c).desc_nulls_first() for c in order_by])
