"""Entity directory, search, histories and dashboard figures."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom import schema as S
from ledgerloom.functions import ids, numbers, text
from ledgerloom.operators import columns as C
from ledgerloom.operators import dedupe, filters, joins, ranking, stats
from ledgerloom.session import materialize, remove_folder, replace_folder, scratch
from ledgerloom.sinks import tables

SUMMARY = "entity_id string, entity_name string, total decimal(38,2), n_amounts long, year int, quarter int"
EXPENSE_ORDER = ("year", "quarter", "entity_name")


def _is_absent(registry: DataFrame | None) -> bool:
    """An empty registry is none."""
    return registry is None or registry.isEmpty()


def serving_expense(raw: DataFrame) -> DataFrame:
    """Exchanged expense rows with serving headers, padded ids and typed values."""
    mapped = C.apply_aliases(raw, S.SERVING_ALIASES, join_words=False, keep_unmapped=True)
    S.require_columns(mapped, S.EXPENSE_COLUMNS, "expense")
    return mapped.withColumns(
        {
            "entity_id": ids.padded_id("entity_id"),
            "amount": numbers.to_decimal(F.col("amount").cast("string")),
            "year": numbers.to_whole(F.col("year").cast("string")),
            "quarter": numbers.to_whole(F.col("quarter").cast("string")),
        }
    )


def serving_registry(raw: DataFrame) -> DataFrame:
    """Registry rows with serving headers; blank or 'nan' attributes become NULL."""
    mapped = C.apply_aliases(raw, S.SERVING_ALIASES, join_words=False, keep_unmapped=True)
    order = [c for c in S.FILE_ORDER if c in mapped.columns]
    full = C.complete_columns(mapped, S.REGISTRY_COLUMNS).select(*S.REGISTRY_COLUMNS, *order)
    cleaned = {c: F.nullif(text.nan_to_blank(c), F.lit("")) for c in ("registration", "region")}
    return full.withColumns({"entity_id": ids.padded_id("entity_id"), **cleaned})


def serving_aggregated(raw: DataFrame) -> DataFrame:
    mapped = C.apply_aliases(raw, S.SERVING_ALIASES, join_words=False, keep_unmapped=True)
    return mapped.withColumns(
        {
            "total": numbers.to_decimal(F.col("total").cast("string")),
            "high_variability": text.parse_boolean(F.col("high_variability").cast("string")),
        }
    )


# --- the serving base ------------------------------------------------------------------


def summarize(expense: DataFrame) -> DataFrame:
    """Expenses per id, name and quarter: what every serving query starts from.

    One pass over the expenses with map-side sums; at scale this table is
    written once and all queries below read it instead of the expenses.
    """
    return expense.groupBy("entity_id", "entity_name", "year", "quarter").agg(
        stats.total("amount").alias("total"), F.count("amount").alias("n_amounts")
    )


def entity_totals(summary: DataFrame) -> DataFrame:
    """Sums of a summary over all periods, per id and name; ``n_periods`` counts its rows."""
    return summary.groupBy("entity_id", "entity_name").agg(
        stats.total("total").alias("total"), F.sum("n_amounts").alias("n_amounts"), F.count(F.lit(1)).alias("n_periods")
    )


def shift_totals(totals: DataFrame, old: DataFrame, new: DataFrame) -> DataFrame:
    """``totals`` after the summary rows ``old`` gave way to ``new``.

    Sums are decimals, so subtracting what was added leaves nothing behind.  Groups without any period go; a
    total without amounts is NULL, as a sum over them is.
    """
    less, more = entity_totals(old), entity_totals(new)
    sums = ("total", "n_amounts", "n_periods")
    less = less.withColumns({c: -F.col(c) for c in sums})
    merged = totals.unionByName(less).unionByName(more).groupBy("entity_id", "entity_name")
    added = merged.agg(stats.total_or_zero("total").alias("total"), *[F.sum(c).alias(c) for c in sums[1:]])
    shown = F.when(F.col("n_amounts") > 0, F.col("total")).cast(stats.TOTAL)
    return added.filter("n_periods > 0").withColumn("total", shown)


def build_summary(spark: SparkSession, expense: str, place: str) -> None:
    """Store the summary of an expense table by period, and its totals, below ``place``."""
    tables.reload(spark.createDataFrame([], SUMMARY), f"{place}/summary")
    tables.load_periods(summarize(spark.read.parquet(expense)), f"{place}/summary")
    tables.reload(entity_totals(read_summary(spark, place)), f"{place}/totals")


def read_summary(spark: SparkSession, place: str) -> DataFrame:
    """The stored summary; its periods are partitions."""
    return spark.read.schema(SUMMARY).parquet(f"{place}/summary")


def read_totals(spark: SparkSession, place: str) -> DataFrame:
    return spark.read.parquet(f"{place}/totals")


def refresh_summary(spark: SparkSession, expense: str, place: str, periods: Iterable[tuple[int | None, int | None]]) -> None:
    """Follow the replacement of some periods of the expense table; only these are read from it.

    The totals move by the difference of the periods' old and new summaries.  They change places
    first and the summary follows, so ``rebuild_totals`` puts right what an interrupted call leaves.
    """
    periods = list(periods)
    chosen = tables.of_periods(periods)
    with scratch(spark):
        new = materialize(summarize(spark.read.parquet(expense).filter(chosen)), "summary-new")
        old = materialize(read_summary(spark, place).filter(chosen), "summary-old")
        beside = f"{place}/totals__next_{uuid.uuid4().hex}"
        shift_totals(read_totals(spark, place), old, new).write.parquet(beside)
        replace_folder(spark, beside, f"{place}/totals")
        tables.load_periods(new, f"{place}/summary")
        present = {(r.year, r.quarter) for r in new.select("year", "quarter").distinct().collect()}
    for year, quarter in set(periods) - present:
        names = ["__HIVE_DEFAULT_PARTITION__" if v is None else v for v in (year, quarter)]
        remove_folder(spark, f"{place}/summary/year={names[0]}/quarter={names[1]}")


def rebuild_totals(spark: SparkSession, place: str) -> None:
    """The totals anew from the summary; the expense table is not read."""
    beside = f"{place}/totals__next_{uuid.uuid4().hex}"
    entity_totals(read_summary(spark, place)).write.parquet(beside)
    replace_folder(spark, beside, f"{place}/totals")


# --- directory and search ------------------------------------------------------------


def first_names(summary: DataFrame, order_by: Iterable[Column | str] = EXPENSE_ORDER) -> DataFrame:
    """The first known name of every id."""
    named = summary.filter(F.col("entity_id").isNotNull() & F.col("entity_name").isNotNull())
    at = F.struct(*order_by)
    return named.groupBy("entity_id").agg(F.min_by("entity_name", at).alias("first_name"))


def entity_directory(
    registry: DataFrame | None,
    summary: DataFrame,
    order_by: Iterable[Column | str] | None = None,
) -> DataFrame:
    """One row per entity; names the registry lacks come from the expenses.

    Without a registry the ids that have expenses are the directory.
    """
    names = first_names(summary)
    if _is_absent(registry):
        absent = {c: F.lit(None).cast("string") for c in ("registration", "category", "region")}
        named = names.withColumnRenamed("first_name", "entity_name").withColumns(absent)
        return named.select(*S.REGISTRY_COLUMNS)
    base = C.complete_columns(registry, S.REGISTRY_COLUMNS)
    padded = base.withColumn("entity_id", ids.padded_id("entity_id"))
    unique = dedupe.keep_first(padded, ["entity_id"], order_by or S.registry_order(base))
    joined = unique.join(names, "entity_id", "left")
    name = F.coalesce("entity_name", "first_name")
    return joined.withColumn("entity_name", name).select(*S.REGISTRY_COLUMNS)


def with_activity(directory: DataFrame, summary: DataFrame) -> DataFrame:
    """Add ``has_data``: a positive total by id, or by normalised name.

    Two equi joins on aggregates take the place of one join with an OR.
    """
    by_id = summary.groupBy("entity_id").agg(stats.total_or_zero("total").alias("_by_id"))
    named = summary.select(text.normal_name("entity_name").alias("_name"), "total")
    by_name = (
        named.filter("_name != ''")
        .groupBy("_name")
        .agg(stats.total_or_zero("total").alias("_by_name"))
    )
    joined = (
        directory.withColumn("_name", text.normal_name("entity_name"))
        .join(by_id, "entity_id", "left")
        .join(by_name, "_name", "left")
    )
    active = (F.coalesce("_by_id", F.lit(0)) > 0) | (F.coalesce("_by_name", F.lit(0)) > 0)
    return joined.select(*directory.columns, active.alias("has_data"))


def search_entities(
    directory: DataFrame,
    page: int = 1,
    limit: int = 20,
    search: str | None = None,
    regex: bool = False,
) -> DataFrame:
    """One page of the directory (with ``has_data``), active entities first.

    Each row also carries the number of hits and of pages.  A page without rows is one row
    that has only these.
    """
    hits = directory.filter(filters.matches_search(search, regex=regex)) if search else directory
    order = [F.col("has_data").desc(), F.col("entity_name").asc_nulls_last(), F.col("entity_id")]
    rows = ranking.page(hits, order, page, limit)
    counted = hits.agg(F.count(F.lit(1)).alias("n_hits")).select(
        "n_hits", F.lit(page).alias("page"), ranking.page_count("n_hits", limit).alias("n_pages")
    )
    shown = C.blank_nulls(rows)
    return counted.join(shown, F.lit(True), "left").select(*shown.columns, *counted.columns)


def find_entity(directory: DataFrame, entity_id: str) -> DataFrame:
    """At most one row."""
    return C.blank_nulls(filters.entity(directory, entity_id).limit(1))


# --- histories -------------------------------------------------------------------------


def _history_totals(summary: DataFrame, key: str) -> DataFrame:
    known = summary.filter(F.col("year").isNotNull() & F.col("quarter").isNotNull())
    return known.groupBy(key, "year", "quarter").agg(stats.total_or_zero("total").alias("total"))


def _with_any_positive(totals: DataFrame) -> DataFrame:
    """Leave out series without a positive total; a series is at most one row per quarter."""
    series = Window.partitionBy("entity_id")
    best = totals.withColumn("_best", F.max("total").over(series))
    return best.filter("_best > 0").drop("_best")


def entity_histories(summary: DataFrame, directory: DataFrame) -> DataFrame:
    """Quarter totals of every entity, for all entities at once.

    Directory entries without expenses under their id take those under their
    normalised name.  A series without any positive total is left out.
    """
    known = summary.filter(F.col("entity_id") != "")
    by_id = _history_totals(known, "entity_id")
    named = directory.select("entity_id", text.normal_name("entity_name").alias("_name"))
    without = named.filter("_name != ''").join(
        known.select("entity_id").distinct(), "entity_id", "left_anti"
    )
    by_name = _history_totals(
        summary.withColumn("_name", text.normal_name("entity_name")), "_name"
    )
    borrowed = without.join(by_name, "_name").select(*by_id.columns)
    return _with_any_positive(by_id.unionByName(borrowed))


def entity_history(summary: DataFrame, directory: DataFrame, entity_id: str) -> DataFrame:
    """The same for one entity, oldest quarter first: filters reach the scans."""
    wanted = ids.padded_id(F.lit(entity_id))
    own = summary.filter(F.col("entity_id") == wanted)
    if own.isEmpty():
        entry = filters.entity(directory, entity_id).select(
            text.normal_name("entity_name").alias("_name")
        )
        names = entry.filter("_name != ''").limit(1)
        named = summary.withColumn("_name", text.normal_name("entity_name"))
        own = named.join(F.broadcast(names), "_name", "left_semi")
    totals = _history_totals(own.withColumn("entity_id", wanted), "entity_id")
    return _with_any_positive(totals).select("year", "quarter", "total").orderBy("year", "quarter")


# --- dashboard ---------------------------------------------------------------------------


def locate(totals: DataFrame, registry: DataFrame) -> DataFrame:
    """Region by id (the last registry row counts), else by normalised name (the
    first counts), else the sentinel.  NULL names match nothing."""
    known = registry.filter("entity_id is not null").withColumn(
        "_region", text.blank_to_null("region")
    )
    order = S.registry_order(registry)
    by_id = dedupe.keep_last(known, ["entity_id"], order).select(
        F.col("entity_id").alias("_table_id"), F.col("_region").alias("_by_id")
    )
    named = known.withColumn("_name", text.normal_name("entity_name")).filter("_name != ''")
    by_name = dedupe.keep_first(named, ["_name"], order).select(
        F.col("_name").alias("_table_name"), F.col("_region").alias("_by_name")
    )
    first = joins.lookup(
        totals, by_id, F.col("entity_id"), F.col("_table_id"), ["_by_id"], spread_by=("total",)
    )
    # names are only looked up where the id gave no region
    open_name = F.when(F.col("_by_id").isNull(), text.normal_name("entity_name"))
    second = joins.lookup(
        first, by_name, open_name, F.col("_table_name"), ["_by_name"], spread_by=("total",)
    )
    region = joins.first_known("_by_id", "_by_name")
    return second.withColumn("region", region).drop("_by_id", "_by_name")


def located_totals(summary: DataFrame, registry: DataFrame | None) -> DataFrame:
    """Totals per (id, name) with their region: what all dashboard parts share."""
    totals = summary.groupBy("entity_id", "entity_name").agg(
        stats.total("total").alias("total"), F.sum("n_amounts").alias("n_amounts")
    )
    if _is_absent(registry):
        return totals.withColumn("region", F.lit(S.UNKNOWN))
    return locate(totals, registry)


def registered_per_region(registry: DataFrame) -> DataFrame:
    region = stats.unknown_group(text.blank_to_null("region"))
    return registry.groupBy(region.alias("region")).agg(
        F.count_distinct("entity_id").alias("n_entities")
    )


def region_totals(located: DataFrame, registry: DataFrame | None) -> DataFrame:
    """Total per region, registered entities and mean per registered entity."""
    totals = located.groupBy("region").agg(stats.total_or_zero("total").alias("total"))
    if _is_absent(registry):
        entities = located.groupBy("region").agg(
            F.count_distinct("entity_id").alias("n_entities")
        )
    else:
        entities = registered_per_region(registry)
    n = F.coalesce("n_entities", F.lit(0))
    mean = F.coalesce(F.try_divide(F.col("total").cast("double"), n), F.lit(0.0))
    joined = totals.join(entities, "region", "left")
    return joined.select("region", "total", mean.alias("mean_per_entity"), n.alias("n_entities"))


def region_totals_from_aggregated(aggregated: DataFrame) -> DataFrame:
    """The same shape from the aggregated table, when there are no expense rows."""
    named = aggregated.withColumn("region", stats.unknown_group("region"))
    return named.groupBy("region").agg(stats.total("total").alias("total")).select(
        "region",
        "total",
        F.lit(0.0).alias("mean_per_entity"),
        F.lit(0).cast("bigint").alias("n_entities"),
    )


def top_entities(located: DataFrame, k: int = 5) -> DataFrame:
    """Largest entities by total; rows without a name do not take part."""
    zero = F.lit(0).cast(stats.TOTAL)
    named = located.filter(F.col("entity_name").isNotNull()).withColumn(
        "total", F.coalesce("total", zero)
    )
    return ranking.top_k(named, "total", k, ["entity_name", "entity_id"]).select(
        "entity_name", "region", "total"
    )


def region_leader(regions: DataFrame) -> DataFrame:
    return ranking.leader(regions, "region", "total", S.UNKNOWN)


def region_chart(regions: DataFrame, metric: str = "total", k: int = 10) -> DataFrame:
    """The k largest regions by total, mean_per_entity or n_entities."""
    if metric not in ("total", "mean_per_entity", "n_entities"):
        raise ValueError(f"unknown metric {metric}")
    return ranking.top_k(regions, metric, k, ["region"])


def count_entities(registry: DataFrame | None, summary: DataFrame) -> DataFrame:
    """One row: the size of the directory, without building it."""
    if _is_absent(registry):
        counted = summary.filter(F.col("entity_name").isNotNull())
        return counted.agg(F.count_distinct("entity_id").alias("n_entities"))
    return registry.agg(F.count_distinct(ids.padded_id("entity_id")).alias("n_entities"))


def dashboard_kpis(
    totals: DataFrame, entities: DataFrame, aggregated: DataFrame | None = None
) -> DataFrame:
    """One row of overall figures; ``totals`` has ``total`` and ``n_amounts`` per group."""
    n = F.sum("n_amounts").cast("double")
    overall = F.try_divide(F.sum("total").cast("double"), n)
    spent = totals.agg(
        stats.total_or_zero("total").alias("total"),
        F.coalesce(overall, F.lit(0.0)).alias("mean"),
    )
    if aggregated is None:
        varying = spent.select(F.lit(0).cast("bigint").alias("n_high_variability"))
    else:
        varying = aggregated.agg(F.count_if("high_variability").alias("n_high_variability"))
    per_entity = F.coalesce(
        F.try_divide(F.col("total").cast("double"), F.col("n_entities")), F.lit(0.0)
    )
    return (
        spent.crossJoin(entities)
        .crossJoin(varying)
        .select("total", "mean", per_entity.alias("mean_per_entity"), "n_entities", "n_high_variability")
    )


def _as_list(df: DataFrame, name: str, order: Column, key: str, descending: bool = True) -> DataFrame:
    """A bounded result as one row with one ordered array of structs."""
    whole = F.struct(*[F.col(c) for c in df.columns])
    tagged = F.struct(order.alias("o"), F.col(key).alias("k"), whole.alias("item"))
    packed = df.agg(F.collect_list(tagged).alias("_items"))
    less = F.lit(1) if descending else F.lit(-1)

    def compare(a: Column, b: Column) -> Column:
        return (
            F.when(a["o"] < b["o"], less)
            .when(a["o"] > b["o"], -less)
            .when(a["k"] < b["k"], -1)
            .when(a["k"] > b["k"], 1)
            .otherwise(0)
        )

    ordered = F.array_sort("_items", compare)
    return packed.select(F.transform(ordered, lambda x: x["item"]).alias(name))


def dashboard_stats(
    summary: DataFrame,
    registry: DataFrame | None,
    aggregated: DataFrame | None = None,
) -> DataFrame:
    """All dashboard figures as one nested row.

    The located totals are written once and shared by all parts.  The arrays
    hold five entities and one item per region, so the row stays small at any
    data size.
    """
    located = materialize(located_totals(summary, registry), "located")
    if aggregated is not None and located.isEmpty():
        regions = region_totals_from_aggregated(aggregated)
    else:
        regions = region_totals(located, registry)
    tops = _as_list(top_entities(located, 5), "top_entities", F.col("total"), "entity_name")
    by_region = _as_list(regions, "regions", F.col("total"), "region")
    first = F.try_element_at("top_entities", F.lit(1))
    named = F.filter("regions", lambda r: r["region"] != S.UNKNOWN)
    lead = F.coalesce(F.try_element_at(named, F.lit(1)), F.try_element_at("regions", F.lit(1)))
    return (
        dashboard_kpis(located, count_entities(registry, summary), aggregated)
        .crossJoin(tops)
        .crossJoin(by_region)
        .withColumn("top_entity", first)
        .withColumn("leading_region", lead)
    )
