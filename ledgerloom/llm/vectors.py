"""Usable vectors of a table, as arrays inside tasks."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import by_value, stored

by_value(__name__)


def is_usable(v: Column) -> Column:
    """Neither null nor zero, and without null or non-finite components."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def usable(df: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, int, int]:
    """(id, v) of the rows that take part, stored; the dimension; and how many there are.

    Vectors of another length than most (ties: the longer) take no part, and neither do rows
    without an id.  Of rows that repeat an id one vector is taken, the one with the smallest hash.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"))
    rows = rows.where(F.col("id").isNotNull() & is_usable(F.col("v")))
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    top = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    dims = top.d if top else 0
    rows = rows.where(F.size("v") == dims)
    again = stored(rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id"), "again")
    if not again.isEmpty():
        several = rows.join(again, "id", "left_semi").groupBy("id").agg(F.min_by("v", F.xxhash64("v")).alias("v"))
        rows = rows.join(again, "id", "left_anti").unionByName(several)
    rows = stored(rows, "vectors")
    return rows, dims, rows.count()


def matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    """The vectors of a column in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.astype(np.float64).reshape(len(column), dims) if dims else np.zeros((len(column), 0))


def sample(rows: DataFrame, bound: int, seed: int) -> pa.Table:
    """At most ``bound`` rows on the driver: those with the smallest hash of their id."""
    drawn = rows.withColumn("_draw", F.xxhash64("id", F.lit(seed))).orderBy("_draw", "id").limit(bound)
    return drawn.drop("_draw").toArrow()


def rotation(dims: int, seed: int = 7) -> np.ndarray:
    """A random rotation: the orthogonal part of a normal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))
