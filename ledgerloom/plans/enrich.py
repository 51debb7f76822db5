"""Registry lookup with match status and coverage reports."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import schema as S
from ledgerloom.functions import ids
from ledgerloom.operators import dedupe, filters, joins, quality, stats
from ledgerloom.operators.ranking import top_k
from ledgerloom.sinks import tables

ATTRIBUTES = ("registration", "category", "region")


def match_table(registry: DataFrame, order_by: Iterable[Column | str] | None = None) -> DataFrame:
    """Registry rows usable for matching: cleaned 14-digit id, first row per id."""
    S.require_columns(registry, ["entity_id"], "registry")
    cleaned = registry.withColumn("entity_id", ids.digits_only("entity_id"))
    unique = dedupe.keep_first(filters.full_length_ids(cleaned), ["entity_id"], order_by or S.registry_order(registry))
    return unique.select("entity_id", *[c for c in ATTRIBUTES if c in registry.columns])


def enrich(expense: DataFrame, registry: DataFrame) -> DataFrame:
    """Every expense row, with registry attributes and ``match_status``.

    The registry side is prepared when this is called, so that its size decides
    whether the expense rows have to be shuffled.
    """
    cleaned = expense.withColumn("entity_id", ids.digits_only("entity_id"))
    table = joins.sized_side(match_table(registry), "registry")
    attributes = [c for c in ATTRIBUTES if c in table.columns]
    found = joins.lookup(
        cleaned,
        table.withColumnRenamed("entity_id", "_table_id"),
        F.col("entity_id"),
        F.col("_table_id"),
        attributes,
        spread_by=("year", "quarter", "amount"),
        hit="_hit",
    )
    return joins.with_match_status(found, "_hit")


def load_for_enrichment(expense: DataFrame, registry: DataFrame, name: str, place: str, buckets: int) -> None:
    """Store expenses and registry bucketed by cleaned id: ``<name>_expense`` and ``<name>_registry``.

    Rows without an id are a plain table of their own below ``place``, for no join needs them in a bucket.
    """
    cleaned = expense.withColumn("entity_id", ids.digits_only("entity_id"))
    keyed, blank = tables.with_key(cleaned, "entity_id")
    tables.load_bucketed(keyed, f"{name}_expense", f"{place}/expense", "entity_id", buckets)
    tables.load_bucketed(match_table(registry), f"{name}_registry", f"{place}/registry", "entity_id", buckets)
    tables.reload(blank, f"{place}/blank")


def enrich_bucketed(spark: SparkSession, name: str, place: str) -> DataFrame:
    """What ``enrich`` gives, from tables that ``load_for_enrichment`` stored: no row is shuffled."""
    keyed, table = spark.table(f"{name}_expense"), spark.table(f"{name}_registry")
    found = keyed.join(table.withColumn("_hit", F.lit(True)), "entity_id", "left").withColumn("_hit", F.coalesce("_hit", F.lit(False)))
    blank = spark.read.parquet(f"{place}/blank").withColumn("_hit", F.lit(False))
    return joins.with_match_status(found.unionByName(blank, allowMissingColumns=True), "_hit")


def totals_bucketed(spark: SparkSession, name: str) -> DataFrame:
    """Total and number of rows of every id, with its attributes; aggregated and joined within buckets."""
    sums = spark.table(f"{name}_expense").groupBy("entity_id").agg(stats.total("amount").alias("total"), F.count(F.lit(1)).alias("n_rows"))
    return sums.join(spark.table(f"{name}_registry"), "entity_id", "left")


def coverage(enriched: DataFrame) -> DataFrame:
    """One row: rows, matched, unmatched, percentage, distinct ids."""
    n, hit = F.count(F.lit(1)), F.count_if(F.col("match_status") == S.MATCHED)
    return enriched.agg(
        n.alias("n_rows"),
        hit.alias("n_matched"),
        (n - hit).alias("n_unmatched"),
        F.try_divide(hit * F.lit(100.0), n).alias("matched_pct"),
        F.count_distinct("entity_id").alias("n_entities"),
    )


def status_frequency(enriched: DataFrame) -> DataFrame:
    """Counts over all three statuses, absent ones as zero."""
    return stats.fixed_domain_frequency(enriched, "match_status", S.MATCH_LABELS)


def region_frequency(enriched: DataFrame, k: int = 10) -> DataFrame:
    return quality.value_counts(enriched, "region").limit(k)


def category_frequency(enriched: DataFrame) -> DataFrame:
    return quality.value_counts(enriched, "category")


def unmatched_ids(enriched: DataFrame, k: int = 10) -> DataFrame:
    """The ids without registry entry that occur most often."""
    missing = enriched.filter(F.col("match_status") == S.UNMATCHED)
    counted = missing.groupBy("entity_id").agg(F.count(F.lit(1)).alias("n"))
    return top_k(counted, "n", k, ["entity_id"])
