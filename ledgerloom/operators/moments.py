"""Exact and mergeable aggregates: moments as decimals, sketches of distinct values and quantiles.

Both are kept per group and merged for any larger one, so figures of a range of periods come from one
small row a period.  Moments are sums of whole cents, so mean and deviation have the same bits whatever the
order and partitioning of the rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.stats import TOTAL, exact_deviation, exact_squares

MOMENTS = ("n", "total", "squares")

# Sketch sizes: 2^14 registers (standard error 0.8 %), and quantiles with ranks off by 0.4 % at 99 % confidence.
DISTINCT_BITS = 14
DISTINCT_ERROR = 1.04 / 2 ** (DISTINCT_BITS / 2)
QUANTILE_SIZE = 800
RANK_ERROR = 0.004


def moments(df: DataFrame, keys: Iterable[str], column: str) -> DataFrame:
    """Count, sum and sum of squared cents of a decimal column per key; NULL values do not count.

    ``squares`` is NULL where it does not fit 38 digits.
    """
    return df.groupBy(*keys).agg(
        F.count(column).alias("n"),
        F.sum(column).cast(TOTAL).alias("total"),
        exact_squares(column).alias("squares"),
    )


def merge_moments(stored: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Moments of larger groups.  One part whose squares are not known makes those of the whole unknown."""
    known = F.bool_and(F.col("squares").isNotNull() | (F.col("n") == 0))
    return stored.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.sum("total").cast(TOTAL).alias("total"),
        F.when(known, F.try_sum("squares")).alias("squares"),
    )


def mean_and_deviation(stored: DataFrame) -> DataFrame:
    """Add ``mean`` and ``std`` (of the sample; 0 for one value, NULL where the squares are not known)."""
    return stored.withColumns(
        {
            "mean": F.try_divide(F.col("total").cast("double"), F.col("n").cast("double")),
            "std": F.when(F.col("n") == 1, F.lit(0.0)).otherwise(exact_deviation("n", "total", "squares")),
        }
    )


# --- sketches ------------------------------------------------------------------------------


def sketches(df: DataFrame, keys: Iterable[str], distinct: str, values: str) -> DataFrame:
    """Per key one sketch of a column's distinct values and one of another column's distribution.

    A row has some 16 KB and 10 KB of them at most, whatever the number of rows behind it.
    """
    number = F.col(values).cast("double")
    return df.groupBy(*keys).agg(
        F.hll_sketch_agg(distinct, F.lit(DISTINCT_BITS)).alias("distinct_sketch"),
        F.kll_sketch_agg_double(number, F.lit(QUANTILE_SIZE)).alias("value_sketch"),
    )


def merge_sketches(stored: DataFrame, keys: Iterable[str] = ()) -> DataFrame:
    return stored.groupBy(*keys).agg(
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("value_sketch").alias("value_sketch"),
    )


def estimates(stored: DataFrame, quantiles: dict[str, float]) -> DataFrame:
    """The number of distinct values and the named quantiles, in place of the sketches; NULL without values."""
    found = {"n_distinct": F.hll_sketch_estimate("distinct_sketch")}
    any_value = F.kll_sketch_get_n_double("value_sketch") > 0
    for name, share in quantiles.items():
        # the guard is evaluated first: an empty sketch has no quantile and would raise
        found[name] = F.when(any_value, F.kll_sketch_get_quantile_double("value_sketch", F.lit(share)))
    kept = [c for c in stored.columns if c not in ("distinct_sketch", "value_sketch")]
    return stored.select(*kept, *[c.alias(name) for name, c in found.items()])
