"""Growth, regional distribution and entities above the mean."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import numbers
from ledgerloom.operators import ranking, stats


def end_points(totals: DataFrame) -> DataFrame:
    """Per id: total of its first and of its last quarter, from its quarter totals.

    Both come from one partial aggregation; where two names share a quarter the
    smallest name counts for the first and the largest for the last.
    """
    known = totals.filter(F.col("year").isNotNull() & F.col("quarter").isNotNull())
    at = F.struct("year", "quarter", "entity_name")
    return known.groupBy("entity_id").agg(
        F.min_by("total", at).alias("first_total"), F.max_by("total", at).alias("last_total")
    )


def top_growth(expense: DataFrame, k: int = 5) -> DataFrame:
    """The k largest growths from first to last quarter, one row per id and name.

    Every row of an id has the same growth, so the best k rows belong to the
    best k ids: only those k rows (the broadcast side) look for their names, in the
    quarter totals that the growth comes from and not in the expenses again.
    """
    identified = expense.filter(F.col("entity_id").isNotNull())
    totals = stats.period_totals(identified, ["entity_id", "entity_name"], drop_null_periods=False)
    points = (
        end_points(totals)
        .filter((F.col("first_total") > 0) & F.col("last_total").isNotNull())
        .withColumn("growth_pct", numbers.growth_pct("first_total", "last_total"))
    )
    best = ranking.top_k(points, "growth_pct", k, ["entity_id"])
    names = totals.select("entity_id", "entity_name")
    named = names.join(F.broadcast(best), "entity_id").distinct()
    return ranking.top_k(named, "growth_pct", k, ["entity_id", "entity_name"]).select(
        "entity_id", "entity_name", "first_total", "last_total", "growth_pct"
    )


def expense_by_region(expense: DataFrame, registry: DataFrame, k: int = 5) -> DataFrame:
    """Largest regions by total, with the mean per entity that has expenses.

    Expenses are summed per id first.  A registry that holds an id several times counts its
    total each time, but the entity once.
    """
    per_id = expense.groupBy("entity_id").agg(stats.total("amount").alias("total"))
    joined = per_id.join(registry.select("entity_id", "region"), "entity_id")
    regions = joined.groupBy("region").agg(
        stats.total("total").alias("total"), F.count_distinct("entity_id").alias("_n")
    )
    mean = F.round(numbers.ratio("total", "_n"), 2).cast(stats.TOTAL)
    return (
        regions.withColumn("mean_per_entity", mean)
        .orderBy(F.col("total").desc_nulls_last(), "region")
        .limit(k)
        .select("region", "total", "mean_per_entity")
    )


def count_above_mean(expense: DataFrame, min_periods: int = 2, mean_over: str = "rows") -> DataFrame:
    """How many entities exceed the overall mean in at least ``min_periods`` quarters.

    The mean is over expense rows, or over quarter totals with
    ``mean_over="periods"``.  Totals are compared with sum / count in exact
    arithmetic.
    """
    totals = stats.period_totals(expense, ["entity_id"], drop_null_periods=False)
    base = expense.select("amount") if mean_over == "rows" else totals.select(F.col("total").alias("amount"))
    overall = base.agg(F.sum("amount").alias("_sum"), F.count("amount").alias("_n"))
    above = F.col("total") * F.col("_n") > F.col("_sum")
    per_entity = (
        totals.crossJoin(F.broadcast(overall))
        .groupBy("entity_id")
        .agg(F.count_if(above).alias("_above"))
    )
    return per_entity.filter(F.col("_above") >= min_periods).agg(
        F.count(F.lit(1)).alias("n_entities")
    )

