"""Global positions, top-k and pages."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import materialize

ROW_BITS = 33


def with_global_position(
    df: DataFrame, order_by: Iterable[Column | str], name: str = "rank", kind: str = "bigint"
) -> DataFrame:
    """Number all rows 1..n in the given total order, without a one-task window.

    The rows are sorted by range and written with their place inside the sorted
    partition; what is missing is one offset per partition.  There are at most
    as many offsets as shuffle partitions, so broadcasting them is bounded.
    """
    ordered = df.orderBy(*order_by).withColumn("_at", F.monotonically_increasing_id())
    stored = materialize(ordered, "ordered")
    part = F.shiftright("_at", ROW_BITS)
    row = F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stored.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    )
    return (
        stored.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, (F.col("_offset") + row + 1).cast(kind))
        .drop("_at", "_part", "_offset")
    )


def top_k(
    df: DataFrame, metric: str, k: int, ties: Iterable[str], descending: bool = True
) -> DataFrame:
    """The k rows with the largest (or smallest) non-NULL metric."""
    column = F.col(metric)
    order = column.desc() if descending else column.asc()
    ties = [F.col(t).asc_nulls_last() for t in ties]
    return df.filter(column.isNotNull()).orderBy(order, *ties).limit(k)


def leader(df: DataFrame, label: str, metric: str, excluded: str) -> DataFrame:
    """The first row by metric that is not the excluded one, or that one if alone."""
    return df.orderBy(
        F.col(label).eqNullSafe(excluded).asc(), F.col(metric).desc_nulls_last(), F.col(label)
    ).limit(1)


def page_count(total: Column | str, size: int) -> Column:
    total = F.col(total) if isinstance(total, str) else total
    return F.greatest(F.lit(1), F.ceil(total / F.lit(size))).cast("int")


def page(df: DataFrame, order_by: Iterable[Column | str], number: int, size: int) -> DataFrame:
    """Rows of one page (1-based) of a totally ordered result, as a top-n for every page.

    Each task keeps the rows up to the page's end; a caller who walks through all of
    a large result numbers it once with ``with_global_position`` instead.
    """
    if number < 1:
        raise ValueError("pages start at 1")
    if not 1 <= size <= 200:
        raise ValueError("a page has 1 to 200 rows")
    return df.orderBy(*order_by).offset((number - 1) * size).limit(size)
