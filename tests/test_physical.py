"""What the plans may and may not contain."""

import re

import pytest
from pyspark.sql import functions as F

from bindings import queries as Q
from bindings import views as V
from ledgerloom import schema as S
from ledgerloom.operators import dedupe, quality
from ledgerloom.plans import enrich, serving, validate
from ledgerloom.sinks import tables
from ledgerloom.sources import delimited


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def full_plan(df):
    return df._jdf.queryExecution().toString()


PYTHON_QUERIES = {"zip_source"}  # archives, but where their lines are stored first


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_no_python_and_no_cartesian_product(spark, sf_dir, name):
    text = plan(Q.QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text
    python = re.search(r"MapInArrow|MapInPandas|ArrowEvalPython|BatchEvalPython", text)
    assert bool(python) == (name in PYTHON_QUERIES)


def test_validation_is_one_scan_without_shuffle(spark, sf_dir):
    orders = V.table(spark, sf_dir, "orders")
    rows = orders.select(
        F.col("o_custkey").cast("string").alias("entity_id"),
        F.col("o_orderpriority").alias("entity_name"),
        F.lit(1).alias("quarter"),
        F.lit(2024).alias("year"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
    )
    text = plan(validate.validate(rows))
    assert "Exchange" not in text and text.count("Scan") == 1


def test_reports_shuffle_one_row_per_task(spark, sf_dir):
    text = plan(validate.quality_report(validate.validate(V.expense(spark, sf_dir))))
    assert "SinglePartition" in text and "SortAggregate" not in text


def test_keep_first_limits_groups_before_the_shuffle(spark, sf_dir):
    rows = V.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    text = plan(dedupe.keep_first(rows, ["o_custkey"], ["o_orderkey"]))
    before, after = text.split("Exchange", 1)
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after


def test_divergence_and_file_description_do_not_sort_rows(spark, sf_dir):
    rows = V.expense(spark, sf_dir)
    assert "SortAggregate" not in plan(quality.divergent_ids(rows, ["src_file", "entity_id"]))
    lines = rows.select(
        "src_file",
        F.encode("entity_name", "UTF-8").alias("raw"),
        F.struct(F.lit(0).alias("a"), "line_no").alias("line_at"),
    )
    text = plan(delimited.describe_files(lines))
    assert "ObjectHashAggregate" in text and "SortAggregate" not in text


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    orders = V.table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("entity_id"),
        F.col("o_orderpriority").alias("entity_name"),
        F.lit(1).alias("quarter"),
        F.lit(2024).alias("year"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        "o_custkey",
    )
    directory = orders.select("entity_id", "entity_name").limit(1)
    text = full_plan(
        serving.entity_history(serving.summarize(orders), directory, "F").select("total")
    )
    assert "o_custkey" not in re.search(r"ReadSchema: struct<[^>]*>", text).group()


def test_one_period_reads_one_partition(spark, tmp_path):
    from ledgerloom.sinks import tables

    rows = V.expense(spark, "/root/testdata/sf0.001").select(
        "entity_id", "entity_name", "year", "quarter", "amount"
    )
    tables.load_periods(rows, str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    text = plan(table.filter("year = 1998 and quarter = 2").select("amount"))
    assert "PartitionFilters: [isnotnull(year" in text and "ReadSchema: struct<amount" in text


def test_wide_registry_is_shuffled_not_broadcast(spark, sf_dir, setting):
    small = plan(enrich.enrich(V.expense(spark, sf_dir), V.registry(spark, sf_dir)))
    assert "BroadcastHashJoin" in small
    setting("spark.sql.autoBroadcastJoinThreshold", "1000")
    large = plan(enrich.enrich(V.expense(spark, sf_dir), V.registry(spark, sf_dir)))
    assert "BroadcastHashJoin" not in large and "SortMergeJoin" in large


def test_period_load_is_rebalanced(spark, sf_dir):
    from ledgerloom.sinks import tables

    rows = V.expense(spark, sf_dir)
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(tables._by_period(rows, tables.PERIOD))


def test_broadcasts_are_bounded_or_planned_by_size(spark, sf_dir, setting):
    """Without small tables, only bounded sides are broadcast."""
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    for name in ("enrich_left", "issue_flags", "dashboard_regions", "entity_history", "upsert_by_key"):
        text = plan(Q.QUERIES[name](spark, sf_dir))
        assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text, name


def test_bucketed_tables_are_joined_and_grouped_in_place(spark, sf_dir, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    name, place = Q._bucketed(spark, sf_dir)
    joined = enrich.enrich_bucketed(spark, name, place)
    assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)
    totals = enrich.totals_bucketed(spark, name)
    assert "SortMergeJoin" in plan(totals) and "Exchange" not in plan(totals)


def test_latest_periods_are_the_only_ones_opened(spark, sf_dir, tmp_path):
    place = str(tmp_path / "t")
    tables.load_periods(V.expense(spark, sf_dir).select(*S.EXPENSE_COLUMNS), place)
    known = tables.stored_periods(spark, place)
    assert "binaryFile" in plan(known) and "content" not in plan(known)
    rows = tables.read_latest_periods(spark, place, 2)
    assert "PartitionFilters: [" in plan(rows) and "PartitionFilters: []" not in plan(rows)
    expected = sorted({(r.year, r.quarter) for r in known.collect()})[-2:]
    assert sorted({(r.year, r.quarter) for r in rows.select("year", "quarter").distinct().collect()}) == expected
    opened = {f.split("/year=")[1].rsplit("/", 1)[0] for f in rows.inputFiles()}
    assert len({f.split("/year=")[1].rsplit("/", 1)[0] for f in spark.read.parquet(place).inputFiles()}) > len(expected)
    read = {r.p for r in rows.select(F.regexp_extract("_metadata.file_path", "year=(.*)/part", 1).alias("p")).distinct().collect()}
    assert len(read) == 2 and opened


def test_a_refresh_reads_the_changed_periods_only(spark, sf_dir, tmp_path):
    place, chosen = str(tmp_path), tables.of_periods([(1995, 1)])
    tables.load_periods(V.expense(spark, sf_dir).select(*S.EXPENSE_COLUMNS), f"{place}/expense")
    read = serving.summarize(spark.read.parquet(f"{place}/expense").filter(chosen))
    assert "PartitionFilters: [(" in plan(read)
    serving.build_summary(spark, f"{place}/expense", place)
    before = sorted(map(str, serving.read_totals(spark, place).collect()))
    serving.refresh_summary(spark, f"{place}/expense", place, [(1995, 1), (None, 2)])
    assert sorted(map(str, serving.read_totals(spark, place).collect())) == before  # nothing had changed
    serving.rebuild_totals(spark, place)
    assert sorted(map(str, serving.read_totals(spark, place).collect())) == before


def test_many_divergent_keys_are_not_held_by_every_task(spark, monkeypatch):
    monkeypatch.setattr(quality, "HELD_KEYS", 2)
    rows = spark.createDataFrame([(f"{i % 5}", "x" * (i % 2 + 1), 1, 2024, 1) for i in range(20)], "entity_id string, entity_name string, quarter int, year int, amount int")
    flagged = quality.flag_issues(rows, ["entity_id"])
    assert "BroadcastHashJoin" not in plan(flagged)
    assert flagged.where(F.contains("issue_flags", F.lit(S.FLAG_DIVERGENT_NAME))).count() == 20


def test_rows_are_not_sorted_for_many_divergent_keys(spark, monkeypatch):
    monkeypatch.setattr(quality, "HELD_KEYS", 2)
    rows = spark.createDataFrame([(f"{i % 5}", "x" * (i % 2 + 1), 1, 2024, 1) for i in range(20)], "entity_id string, entity_name string, quarter int, year int, amount int")
    text = plan(quality.flag_issues(rows, ["entity_id"]))
    assert "ShuffledHashJoin" in text and "Sort" not in text
    assert plan(quality.divergent_ids(rows, ["entity_id"])).count("Exchange") == 1
