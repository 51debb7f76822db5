"""Moments, sketches, the trigram index and the functions of SQL."""

import math
import random
import re
import statistics
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from bindings import views as V
from ledgerloom.functions import ids, numbers, sql, text
from ledgerloom.operators import filters, moments, stats
from ledgerloom.plans import search_index, serving

# --- moments and sketches -----------------------------------------------------------


@pytest.fixture(scope="module")
def amounts(spark):
    draw = random.Random(7)
    rows = [(f"g{i % 5}", i % 8, D(draw.randint(-(10**14), 10**14)) / 100) for i in range(4000)]
    rows += [("one", 0, D("3.10")), ("none", 0, None), ("none", 1, None), ("large", 0, D(10) ** 30), ("large", 1, D("1.00"))]
    return spark.createDataFrame(rows, "k string, part int, v decimal(38,2)").cache()


def test_deviation_is_that_of_exact_arithmetic(amounts):
    rows = {r.k: r for r in moments.mean_and_deviation(moments.moments(amounts, ["k"], "v")).collect()}
    for key in ("g0", "g3"):
        own = [r.v for r in amounts.filter(F.col("k") == key).collect()]
        assert math.isclose(rows[key].std, float(statistics.stdev(own)), rel_tol=1e-15)
        assert rows[key].total == sum(own) and rows[key].n == len(own)
    assert rows["one"].std == 0.0 and rows["one"].mean == 3.1
    assert rows["none"].n == 0 and rows["none"].mean is None and rows["none"].std is None
    assert rows["large"].squares is None and rows["large"].std is None


def test_moments_have_the_same_bits_under_any_partitioning(amounts):
    whole = moments.mean_and_deviation(moments.moments(amounts, ["k"], "v")).collect()
    for order in (F.rand(1), F.col("v"), F.rand(2)):
        mixed = amounts.repartition(7, order)
        parts = moments.moments(mixed, ["k", "part"], "v")
        merged = moments.mean_and_deviation(moments.merge_moments(parts, ["k"]))
        assert sorted(merged.collect()) == sorted(whole)


def test_unknown_squares_stay_unknown_when_merged(amounts):
    merged = moments.mean_and_deviation(moments.merge_moments(moments.moments(amounts, ["k"], "v"), []))
    row = merged.first()
    assert row.n == 4003 and row.std is None


def test_quarter_statistics_beyond_38_digits_fall_back_to_doubles(amounts):
    rows = {r.k: r for r in stats.quarter_statistics(amounts.withColumnRenamed("v", "total"), ["k"]).collect()}
    assert math.isclose(rows["large"].std, 10**30 / math.sqrt(2), rel_tol=1e-12)
    assert rows["none"].std == 0.0 and rows["one"].std == 0.0


def test_a_close_spread_of_large_values_is_not_lost(spark):
    rows = [("a", D("1000000000000.01")), ("a", D("1000000000000.02"))]
    df = spark.createDataFrame(rows, "k string, total decimal(38,2)")
    assert math.isclose(stats.quarter_statistics(df, ["k"]).first().std, 0.01 / math.sqrt(2), rel_tol=1e-12)


def test_merged_sketches_estimate_within_their_bounds(spark):
    df = spark.range(60_000).selectExpr("id % 6 AS period", "cast(id % 20000 AS string) AS name", "cast(id AS double) AS v")
    merged = moments.merge_sketches(moments.sketches(df, ["period"], "name", "v"))
    row = moments.estimates(merged, {"low": 0.1, "middle": 0.5}).first()
    assert abs(row.n_distinct - 20_000) <= 3 * moments.DISTINCT_ERROR * 20_000
    assert abs(row.middle / 60_000 - 0.5) <= 2 * moments.RANK_ERROR
    assert abs(row.low / 60_000 - 0.1) <= 2 * moments.RANK_ERROR


def test_sketches_of_nothing(spark):
    df = spark.createDataFrame([("a", None, None)], "k string, name string, v double")
    stored = moments.sketches(df, ["k"], "name", "v")
    assert moments.estimates(stored, {"p": 0.5}).first()[1:] == (0, None)
    none = moments.merge_sketches(stored.filter("false"))
    assert moments.estimates(none, {"p": 0.5}).first()[:] == (0, None)


def _metrics(plan):
    """All metrics of the leaves of a plan, as text."""
    leaves = plan.collectLeaves()
    return ", ".join(
        f"{m._2().name().get()}: {m._2().value()}"
        for at in range(leaves.size())
        for m in _scala(leaves.apply(at).metrics().toList())
    )


def _scala(values):
    return [values.apply(i) for i in range(values.size())]


# --- search by trigrams ---------------------------------------------------------------

NAMES = ["Lago Azul Saúde", "LAGO VERDE", "lagolago", "São João", "100% Vida", "ab", "", None, "a_b.c*d", "İstanbul Saúde"]


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    rows = [(f"{i * 7919:014d}", str(i), NAMES[i % len(NAMES)], "", "PR", i % 3 == 0) for i in range(400)]
    rows += [(None, "x", "Lago sem id", "", "PR", False), ("", "y", "Lago em branco", "", "PR", True)]
    rows += [rows[0], rows[0][:2] + ("Outra Lagoa",) + rows[0][3:]]  # repeated ids
    kinds = "entity_id string, registration string, entity_name string, category string, region string, has_data boolean"
    directory = spark.createDataFrame(rows, kinds)
    place = str(tmp_path_factory.mktemp("index"))
    search_index.build(directory, place)
    return directory, place


SEARCHED = ["lago", "AGO", "saúde", "SAÚDE", "00000791", "lago 7919", "100%", "%", "_b.", "c*d", "ab", "7", "xyzxyz", "İst", " "]


@pytest.mark.parametrize("search", SEARCHED)
@pytest.mark.parametrize("named", [0, 1000])
def test_index_finds_what_a_scan_finds(spark, indexed, monkeypatch, search, named):
    monkeypatch.setattr(search_index, "NAMED", named)
    directory, place = indexed
    key = lambda row: tuple(str(v) for v in row)
    found = sorted(search_index.hits(spark, place, search).collect(), key=key)
    assert found == sorted(directory.filter(filters.matches_search(search)).collect(), key=key)


def test_pages_of_the_index_are_those_of_the_directory(spark, indexed):
    directory, place = indexed
    for page, search in ((2, "lago"), (1, None), (99, "lago"), (1, "zzzz")):
        found = search_index.search_entities(spark, place, page, 7, search).collect()
        known = serving.search_entities(directory, page, 7, search).collect()
        names = [(r.entity_id, r.has_data, r.n_hits, r.n_pages) for r in known]
        assert [(r.entity_id, r.has_data, r.n_hits, r.n_pages) for r in found] == names


def test_an_empty_directory_has_an_index(spark, indexed, tmp_path):
    directory, _ = indexed
    search_index.build(directory.filter("false"), str(tmp_path))
    assert search_index.hits(spark, str(tmp_path), "lago").count() == 0


def test_a_search_opens_the_lists_of_its_trigrams_only(spark, indexed):
    _, place = indexed
    found = search_index.candidates(spark, place, "name", "verde")
    read = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in read and "IN " in read.split("PartitionFilters")[1]
    assert "In(gram, [" in read and "EqualTo(field,name)" in read
    assert found.count() == 40
    lists = spark.read.schema(search_index._POSTINGS).parquet(f"{place}/postings")
    scan = search_index._of_grams(lists, "name", ["ver", "erd"])._jdf.queryExecution().executedPlan()
    scan.execute().count()
    opened = re.search(r"number of partitions read: (\d+)", str(_metrics(scan)))
    assert opened and int(opened[1]) <= 2


# --- functions of SQL ---------------------------------------------------------------------

TEXTS = [
    "11222333000181", "11.222.333/0001-81", "", "  a  b ", None, "0", "00000000000000", "11111111111111", "1.234,56",
    "1234.56", "1e5", "-3", "x,1", "123456789012345", "12,5,6", " \t lago   azul\n", "11222333000182", "-.5", "1,", ",",
]
PAIRS = {
    "digits_only": ids.digits_only,
    "padded_id": ids.padded_id,
    "format_id": ids.format_id,
    "id_number": ids.id_number,
    "has_valid_check_digits": ids.has_valid_check_digits,
    "normal_name": text.normal_name,
    "comma_decimal": numbers.comma_decimal,
    "mixed_decimal": numbers.mixed_decimal,
}


@pytest.mark.parametrize("name", sorted(PAIRS))
def test_sql_function_equals_its_expression(spark, name):
    sql.register(spark)
    df = spark.createDataFrame([(v,) for v in TEXTS], "v string")
    rows = df.select("v", PAIRS[name]("v").alias("known"), F.expr(f"{name}(v)").alias("found")).collect()
    assert [r.found for r in rows] == [r.known for r in rows]


def test_sql_growth_equals_its_expression(spark):
    sql.register(spark)
    rows = [(D("3.00"), D("4.00")), (D(0), D(1)), (None, D(1)), (D("3.00"), None), (D("-7.00"), D("2.00"))]
    df = spark.createDataFrame(rows, "a decimal(38,2), b decimal(38,2)")
    shown = df.select(numbers.growth_pct("a", "b").cast("double").alias("known"), F.expr("growth_pct(a, b)").alias("found"))
    assert all(r.known == r.found for r in shown.collect())


def test_sql_history_equals_the_plan(spark, sf_dir):
    summary = serving.summarize(V.expense(spark, sf_dir))
    sql.register(spark, summary)
    found = spark.sql("SELECT * FROM entity_history('00.000.000/0000-17') ORDER BY year, quarter").collect()
    known = serving.entity_history(summary, V.registry(spark, sf_dir), "17").collect()
    assert [tuple(r) for r in found] == [tuple(r) for r in known] and found
    assert spark.sql("SELECT * FROM entity_history('')").count() == 0


def test_sql_functions_are_inlined(spark):
    sql.register(spark)
    df = spark.createDataFrame([("1",)], "v string").selectExpr("has_valid_check_digits(v)", "padded_id(v)")
    read = df._jdf.queryExecution().executedPlan().toString()
    assert "regexp" in read and "Python" not in read and "Exchange" not in read
