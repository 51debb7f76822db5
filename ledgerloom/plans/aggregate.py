"""Two-level statistics per entity and region, ranked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom import schema as S
from ledgerloom.operators import columns as C
from ledgerloom.operators import filters, joins, ranking, stats
from ledgerloom.plans import enrich as E

GROUP = ("entity_name", "region")


def group_statistics(enriched: DataFrame) -> DataFrame:
    """Statistics of the quarter totals per (name, region), unranked."""
    S.require_columns(enriched, GROUP, "enriched")
    usable = C.fill_unknown(filters.countable_amounts(enriched), GROUP)
    return stats.quarter_statistics(stats.period_totals(usable, GROUP), GROUP)


def rank_groups(groups: DataFrame) -> DataFrame:
    order = [F.col("total").desc_nulls_last(), F.col("entity_name"), F.col("region")]
    ranked = ranking.with_global_position(groups, order, "rank", "int")
    return ranked.select(*S.AGGREGATED_COLUMNS)


def aggregate_rank(enriched: DataFrame) -> DataFrame:
    """The ranked table from rows that already carry their region."""
    return rank_groups(group_statistics(enriched))


def enrich_and_aggregate(expense: DataFrame, registry: DataFrame) -> DataFrame:
    """The same groups straight from expenses and registry, unranked.

    Amounts are summed per id and quarter before the registry is joined, so the
    join sees a few rows per id instead of every expense line; sums of decimals
    are exact, so the second sum gives the same totals.
    """
    usable = filters.countable_amounts(expense)
    by_id = stats.period_totals(usable, ["entity_id", "entity_name"])
    found = joins.lookup(
        by_id,
        E.match_table(registry).withColumnRenamed("entity_id", "_table_id"),
        F.col("entity_id"),
        F.col("_table_id"),
        ["region"],
        spread_by=("total",),
    )
    named = C.fill_unknown(found, GROUP)
    by_group = named.groupBy(*GROUP, "year", "quarter").agg(stats.total("total").alias("total"))
    return stats.quarter_statistics(by_group, GROUP)


def enrich_and_rank(expense: DataFrame, registry: DataFrame) -> DataFrame:
    return rank_groups(enrich_and_aggregate(expense, registry))


def describe_groups(aggregated: DataFrame) -> DataFrame:
    """One row over all groups: totals, median, spread, variability, regions.

    Reads its input twice: pass a stored table, ranked or not.
    """
    return stats.describe(
        aggregated,
        "total",
        [
            F.count_if("high_variability").alias("n_high_variability"),
            F.count_distinct("region").alias("n_regions"),
        ],
    )


def top_groups(aggregated: DataFrame, k: int = 10) -> DataFrame:
    ranked = aggregated.select("rank", "entity_name", "region", "total")
    return ranked.orderBy("rank").limit(k)


def top_regions(aggregated: DataFrame, k: int = 5) -> DataFrame:
    totals = aggregated.groupBy("region").agg(stats.total("total").alias("total"))
    return ranking.top_k(totals, "total", k, ["region"])
