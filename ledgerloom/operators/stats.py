"""Grouped statistics, descriptive statistics and frequency tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom import schema as S
from ledgerloom.session import materialize

TOTAL = "decimal(38,2)"

# Bounds of the variability bands, in percent.
LOW_BELOW, HIGH_ABOVE = 25, 50


def total(c: Column | str) -> Column:
    return F.sum(c).cast(TOTAL)


def mean(c: str) -> Column:
    """Exact sum over count as a double; NULL on no values."""
    return F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double"))


def exact_squares(c: str) -> Column:
    """Sum of squared cents as a whole number; NULL beyond 38 digits."""
    cents = (F.col(c).cast(TOTAL) * 100).try_cast("decimal(19,0)")
    squared = F.try_multiply(cents, cents).cast("decimal(38,0)")
    fits = F.bool_and(cents.isNotNull() | F.col(c).isNull())
    return F.when(fits, F.try_sum(squared))


def exact_deviation(n: str, total: str, squares: str) -> Column:
    """Sample standard deviation from count, decimal sum and squared cents.

    n * squares - total^2 is a whole number, so nothing is rounded before the last steps and the order of the rows does
    not show.  NULL below two values, or where that number does not fit 38 digits.
    """
    count = F.col(n).cast("decimal(19,0)")
    cents = (F.col(total).cast(TOTAL) * 100).try_cast("decimal(38,0)")
    spread = F.try_subtract(F.try_multiply(count, F.col(squares)), F.try_multiply(cents, cents))
    pairs = (count * (count - 1)).cast("double")
    return F.when(F.col(n) > 1, F.sqrt(F.try_divide(spread.cast("double"), pairs)) / 100)


def period_totals(df: DataFrame, keys: Iterable[str], drop_null_periods: bool = True) -> DataFrame:
    """Sum per key and quarter; periods that are not known can be left out."""
    if drop_null_periods:
        df = df.filter(F.col("year").isNotNull() & F.col("quarter").isNotNull())
    return df.groupBy(*keys, "year", "quarter").agg(total("amount").alias("total"))


def variability(df: DataFrame) -> DataFrame:
    """Coefficient of variation in percent; a zero mean gives NULL and 'not high'."""
    cv = F.try_divide(F.col("std"), F.col("mean")) * 100
    return df.withColumn("cv_pct", cv).withColumn(
        "high_variability", F.coalesce(F.col("cv_pct") > HIGH_ABOVE, F.lit(False))
    )


def quarter_statistics(totals: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Second level: statistics over the quarter totals of each group.

    The deviation is exact, so it has the same bits under any partitioning.
    """
    grouped = totals.groupBy(*keys).agg(
        total("total").alias("_sum"),
        mean("total").alias("mean"),
        exact_squares("total").alias("_squares"),
        F.stddev_samp(F.col("total").cast("double")).alias("_std"),
        F.count("total").cast("int").alias("n_quarters"),
    )
    exact = exact_deviation("n_quarters", "_sum", "_squares")
    named = grouped.select(
        *keys,
        F.col("_sum").alias("total"),
        "mean",
        # beyond 38 digits only doubles are left
        F.coalesce(exact, "_std", F.lit(0.0)).alias("std"),
        "n_quarters",
    )
    return variability(named.withColumn("mean_per_quarter", F.col("mean")))


def variability_bands(df: DataFrame, cv: str = "cv_pct") -> DataFrame:
    """Groups below 25 %, from 25 to 50 % and above; an unknown cv is in none."""
    c = F.col(cv)
    return df.agg(
        F.count_if(c < LOW_BELOW).alias("low"),
        F.count_if(c.between(LOW_BELOW, HIGH_ABOVE)).alias("medium"),
        F.count_if(c > HIGH_ABOVE).alias("high"),
    )


def exact_median(df: DataFrame, column: str) -> DataFrame:
    """One row with the exact median of a column, at any size.

    Values are counted (map side first) and sorted by range; the sizes of the
    sorted partitions, at most one row per shuffle partition, tell which one or
    two partitions hold the middle, and only those are cumulated.
    """
    counted = (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("_value"))
        .agg(F.count(F.lit(1)).alias("_weight"))
    )
    placed = counted.orderBy("_value").withColumn(
        "_part", F.shiftright(F.monotonically_increasing_id(), 33)
    )
    stored = materialize(placed, "median")
    sizes = stored.groupBy("_part").agg(F.sum("_weight").alias("_size"))
    by_part = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy()
    bounds = (
        sizes.withColumn("_end", F.sum("_size").over(by_part))
        .withColumn("_n", F.sum("_size").over(whole))
        .withColumn("_start", F.col("_end") - F.col("_size"))
        .withColumn("_low", F.floor((F.col("_n") + 1) / 2))
        .withColumn("_high", F.floor(F.col("_n") / 2) + 1)
        .filter((F.col("_start") < F.col("_high")) & (F.col("_end") >= F.col("_low")))
        .select("_part", "_start", "_low", "_high")
    )
    # at most one row per sorted partition: bounded by the shuffle setting
    near = stored.join(F.broadcast(bounds), "_part")
    inside = Window.partitionBy("_part").orderBy("_value")
    before = F.col("_start") + F.sum("_weight").over(inside) - F.col("_weight")
    picked = near.withColumn("_before", before).filter(
        (F.col("_before") < F.col("_high"))
        & (F.col("_before") + F.col("_weight") >= F.col("_low"))
    )
    value = F.col("_value").cast("double")
    return picked.agg(((F.min(value) + F.max(value)) / 2).alias("median"))


def describe(df: DataFrame, column: str, extra: Iterable[Column] = ()) -> DataFrame:
    """One row: count of values, sum, mean, median, min, max, sample std and extras.

    Everything but the median comes from one pass.
    """
    basic = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(column).alias("n_values"),
        total(column).alias("total"),
        mean(column).alias("mean"),
        F.min(column).alias("minimum"),
        F.max(column).alias("maximum"),
        F.stddev_samp(F.col(column).cast("double")).alias("std"),
        *extra,
    )
    return basic.crossJoin(exact_median(df, column))


def fixed_domain_frequency(df: DataFrame, column: str, domain: Iterable[str]) -> DataFrame:
    """Counts and percentages over a given list of values, absent ones as zero."""
    domain = list(domain)
    counted = df.agg(
        F.count(column).alias("_all"),
        *[F.count_if(F.col(column) == value).alias(f"_{i}") for i, value in enumerate(domain)],
    )
    pairs = F.array(
        *[
            F.struct(F.lit(value).alias(column), F.col(f"_{i}").alias("n"))
            for i, value in enumerate(domain)
        ]
    )
    return counted.select("_all", F.inline(pairs)).select(
        column, "n", F.try_divide(F.col("n") * F.lit(100.0), F.col("_all")).alias("pct")
    )


def row_counts_by_period(df: DataFrame) -> DataFrame:
    """Rows per (year, quarter), newest first."""
    return (
        df.filter(F.col("year").isNotNull() & F.col("quarter").isNotNull())
        .groupBy("year", "quarter")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("year"), F.desc("quarter"))
    )


def unknown_group(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(S.UNKNOWN))


def total_or_zero(c: Column | str) -> Column:
    """A sum that is 0 where every value is NULL."""
    return F.coalesce(total(c), F.lit(0).cast(TOTAL))
