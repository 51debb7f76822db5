"""Lookups, match indicators and fallbacks.

Registries grow too, so no lookup side is broadcast by a hint: it is stored, and the
planner decides by its size; in shuffle joins adaptive execution splits hot keys.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import schema as S
from ledgerloom.session import materialize

BLANK_SPREAD = 1024

def sized_side(df: DataFrame, label: str) -> DataFrame:
    """A lookup side whose true size the planner knows when it is joined.

    It is written once; from the files' sizes Spark decides between a broadcast, for which
    the rows it is joined to are not shuffled at all, and a shuffle join.
    """
    return materialize(df, label)


def spread_blank(key: Column, spread_by: Iterable[Column | str]) -> Column:
    """A join key in which blank ids, which match nothing, do not share a task.

    They get a key no id can have, spread by a hash of the row's other columns.
    """
    noise = F.pmod(F.xxhash64(*spread_by), F.lit(BLANK_SPREAD)).cast("string")
    return F.when(key.isNull() | (key == ""), F.concat(F.lit("blank:"), noise)).otherwise(key)


def lookup(
    rows: DataFrame,
    table: DataFrame,
    rows_key: Column,
    table_key: Column,
    columns: Iterable[str],
    spread_by: Iterable[Column | str] = ("amount",),
    hit: str | None = None,
) -> DataFrame:
    """Left join on a unique key; ``hit`` names a column telling matched rows."""
    columns = list(columns)
    found = table.filter(table_key.isNotNull() & (table_key != "")).select(
        table_key.alias("_found"), *columns
    )
    keyed = rows.withColumn("_key", spread_blank(rows_key, spread_by))
    joined = keyed.join(found, F.col("_key") == F.col("_found"), "left")
    if hit:
        joined = joined.withColumn(hit, F.col("_found").isNotNull())
    return joined.drop("_key", "_found")


def with_match_status(df: DataFrame, hit: str, status: str = "match_status") -> DataFrame:
    label = F.when(F.col(hit), F.lit(S.MATCHED)).otherwise(F.lit(S.UNMATCHED))
    return df.withColumn(status, label).drop(hit)


def first_known(*columns: str, default: str = S.UNKNOWN) -> Column:
    """The first lookup that answered, else the sentinel."""
    return F.coalesce(*[F.col(c) for c in columns], F.lit(default))
