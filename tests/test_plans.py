from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from bindings import views as V
from ledgerloom import schema as S
from ledgerloom.operators import dedupe, joins, quality
from ledgerloom.plans import aggregate, analytics, enrich, serving, validate

ALFA = "11222333000181"


@pytest.fixture(scope="module")
def served(spark):
    expense = spark.createDataFrame(
        [(ALFA, "LAGO AZUL SAUDE", str(q), "2023", v, "") for q, v in ((2, "80.25"), (3, "120.75"), (4, "99.00"))],
        ["CNPJ", "RazaoSocial", "Trimestre", "Ano", "ValorDespesas", "inconsistencia_flag"],
    )
    aggregated = spark.createDataFrame(
        [("1", "LAGO AZUL SAUDE", "PR", "300.00", "100.00", "100.00", "20.27", "20.27", "3", "false")],
        ["Ranking", "RazaoSocial", "UF", "TotalDespesas", "MediaDespesas", "MediaPorTrimestre",
         "DesvioPadrao", "CoeficienteVariacao", "NumeroTrimestres", "AltaVariabilidade"],
    )
    registry = spark.createDataFrame(
        [("4711", ALFA, "LAGO AZUL SAUDE", "Cooperativa", "PR")],
        ["Registro_Operadora", "CNPJ", "Razao_Social", "Modalidade", "UF"],
    )
    return (
        serving.serving_expense(expense),
        serving.serving_registry(registry),
        serving.serving_aggregated(aggregated),
    )


def test_listing(served):
    expense, registry, _ = served
    summary = serving.summarize(expense)
    listed = serving.with_activity(serving.entity_directory(registry, summary), summary)
    row = serving.search_entities(listed, page=1, limit=5).first()
    assert row.has_data and row.n_hits == 1 and row.n_pages == 1 and row.registration == "4711"


def test_history(served):
    expense, registry, _ = served
    summary = serving.summarize(expense)
    rows = serving.entity_history(summary, registry, "11.222.333/0001-81").collect()
    assert [(r.year, r.quarter, r.total) for r in rows] == [
        (2023, 2, D("80.25")),
        (2023, 3, D("120.75")),
        (2023, 4, D("99.00")),
    ]


def test_unknown_entity(served):
    expense, registry, _ = served
    summary = serving.summarize(expense)
    directory = serving.entity_directory(registry, summary)
    assert serving.find_entity(directory, "0" * 14).count() == 0
    assert serving.entity_history(summary, directory, "0" * 14).count() == 0


def test_statistics(served):
    expense, registry, aggregated = served
    row = serving.dashboard_stats(serving.summarize(expense), registry, aggregated).first()
    assert row.total == D("300.00") and abs(row["mean"] - 100) < 1e-9
    assert row.n_entities == 1 and row.mean_per_entity == 300 and row.n_high_variability == 0
    assert row.top_entity.entity_name == "LAGO AZUL SAUDE" and row.top_entity.region == "PR"
    assert [(r.region, r.n_entities) for r in row.regions] == [("PR", 1)]
    assert row.leading_region.region == "PR"


def test_growth_of_the_fixture(served):
    expense, _, _ = served
    row = analytics.top_growth(expense).first()
    assert (row.first_total, row.last_total, row.growth_pct) == (D("80.25"), D("99.00"), D("23.36"))


def test_statistics_without_rows_use_the_aggregated_table(spark, served):
    expense, registry, aggregated = served
    row = serving.dashboard_stats(serving.summarize(expense.limit(0)), registry, aggregated).first()
    assert row.total == 0 and row["mean"] == 0 and row.top_entities == [] and row.top_entity is None
    assert [(r.region, r.total, r.n_entities) for r in row.regions] == [("PR", D("300.00"), 0)]


def test_nothing_at_all(spark, served):
    expense, registry, _ = served
    row = serving.dashboard_stats(serving.summarize(expense.limit(0)), registry.limit(0)).first()
    assert row.total == 0 and row.n_entities == 0 and row.regions == [] and row.leading_region is None


def test_directory_without_registry(served):
    expense, _, _ = served
    rows = serving.entity_directory(None, serving.summarize(expense)).collect()
    assert [(r.entity_id, r.entity_name, r.region) for r in rows] == [(ALFA, "LAGO AZUL SAUDE", None)]


def test_region_by_id_then_name_then_sentinel(spark):
    registry = spark.createDataFrame(
        [("1", "a", "Um", "SP"), ("2", "a", "Um", "RJ"), ("3", "b", " dois ", "MG"), ("4", "c", "Tres", ""), ("5", "d", None, "BA")],
        "registration string, entity_id string, entity_name string, region string",
    )
    totals = spark.createDataFrame(
        [("a", "x", 1), ("", "DOIS", 2), ("c", "Tres", 3), ("", None, 4), ("zz", "um", 5)],
        "entity_id string, entity_name string, total int",
    )
    done = {r.total: r.region for r in serving.locate(totals, registry).collect()}
    # the last registry row counts by id, the first by name; a blank region is unknown
    assert done == {1: "RJ", 2: "MG", 3: "NÃO_INFORMADO", 4: "NÃO_INFORMADO", 5: "SP"}


def test_series_without_a_positive_total_is_left_out(spark):
    df = spark.createDataFrame(
        [("a", "A", 2024, 1, D(-5)), ("a", "A", 2024, 2, None), ("b", "B", 2024, 1, D(0)), ("b", "B", 2024, 2, D(1)), ("b", "B", None, 2, D(9))],
        "entity_id string, entity_name string, year int, quarter int, amount decimal(18,2)",
    )
    directory = df.select("entity_id", "entity_name").distinct()
    rows = serving.entity_histories(serving.summarize(df), directory).collect()
    assert sorted((r.entity_id, r.quarter, r.total) for r in rows) == [("b", 1, D("0.00")), ("b", 2, D("1.00"))]


def test_chart_by_each_metric(spark):
    regions = spark.createDataFrame(
        [("A", D(5), 1.0, 9), ("B", D(3), 2.0, 1), ("C", D(4), None, 5)],
        "region string, total decimal(38,2), mean_per_entity double, n_entities long",
    )
    order = {
        m: [r.region for r in serving.region_chart(regions, m, 2).collect()]
        for m in ("total", "mean_per_entity", "n_entities")
    }
    assert order == {"total": ["A", "C"], "mean_per_entity": ["B", "A"], "n_entities": ["A", "C"]}
    with pytest.raises(ValueError):
        serving.region_chart(regions, "region")


# --- analytics edges ------------------------------------------------------------------


@pytest.fixture(scope="module")
def grown(spark):
    return spark.createDataFrame(
        [
            ("a", "A", 2023, 1, D(100)), ("a", "A", 2024, 1, D(150)), ("a", "A2", 2023, 3, D(1)),
            ("z", "Z", 2023, 1, D(0)), ("z", "Z", 2024, 1, D(10)),
            ("n", "N", 2023, 1, D(10)), ("n", "N", 2024, 1, None),
            ("m", "M", 2023, 1, D(-5)), ("m", "M", 2024, 1, D(10)),
            ("s", "S", 2023, 1, D(10)),
            ("u", "U", None, 1, D(1)), ("u", "U", 2023, 1, D(10)), ("u", "U", 2024, 1, D(5)),
        ],
        "entity_id string, entity_name string, year int, quarter int, amount decimal(18,2)",
    )


def test_growth_guards(grown):
    rows = [(r.entity_id, r.entity_name, r.growth_pct) for r in analytics.top_growth(grown, 10).collect()]
    assert rows == [("a", "A", D("50.00")), ("a", "A2", D("50.00")), ("s", "S", D("0.00")), ("u", "U", D("-50.00"))]


def test_mean_over_rows_or_periods(spark):
    df = spark.createDataFrame(
        [("a", 2024, q, D(v)) for q, v in ((1, 6), (1, 6), (2, 9), (3, 3))] + [("b", 2024, 1, D(1)), ("b", 2024, 2, None)],
        "entity_id string, year int, quarter int, amount decimal(18,2)",
    )
    # rows: mean 5; quarter totals of a are 12, 9, 3
    assert analytics.count_above_mean(df).first().n_entities == 1
    assert analytics.count_above_mean(df, min_periods=3).first().n_entities == 0
    # totals 12, 9, 3, 1: mean 6.25
    assert analytics.count_above_mean(df, mean_over="periods").first().n_entities == 1


def test_region_mean_counts_entities_with_expenses(spark):
    expense = spark.createDataFrame([("a", D(10)), ("a", D(5)), ("b", None), ("x", D(9))], "entity_id string, amount decimal(18,2)")
    registry = spark.createDataFrame([("a", "SP"), ("b", "SP"), ("c", "SP"), ("x", None)], "entity_id string, region string")
    rows = {r.region: (r.total, r.mean_per_entity) for r in analytics.expense_by_region(expense, registry).collect()}
    assert rows == {"SP": (D("15.00"), D("7.50")), None: (D("9.00"), D("9.00"))}


# --- properties on the given tables -------------------------------------------------------


def test_enrich_keeps_rows_and_adds_attributes(spark, sf_dir):
    expense, registry = V.expense(spark, sf_dir), V.registry(spark, sf_dir)
    done = enrich.enrich(expense, registry)
    assert done.count() == expense.count()
    doubled = registry.union(registry.withColumn("region", F.lit("other")))
    assert enrich.enrich(expense, doubled).count() == expense.count()
    empty = enrich.enrich(expense, registry.limit(0))
    assert {r.match_status for r in empty.select("match_status").distinct().collect()} == {S.UNMATCHED}
    cover = enrich.coverage(empty).first()
    assert cover.n_matched == 0 and cover.n_unmatched == expense.count()


def test_coverage_of_nothing_is_null(spark, sf_dir):
    none = enrich.enrich(V.expense(spark, sf_dir).limit(0), V.registry(spark, sf_dir))
    assert enrich.coverage(none).first().matched_pct is None


def test_aggregating_before_the_join_changes_nothing(spark, sf_dir):
    expense, registry = V.expense(spark, sf_dir), V.registry(spark, sf_dir)
    late = aggregate.group_statistics(enrich.enrich(expense, registry))
    early = aggregate.enrich_and_aggregate(expense, registry)
    exact = ["entity_name", "region", "total", "mean", "n_quarters", "high_variability"]
    assert late.select(exact).exceptAll(early.select(exact)).count() == 0
    assert early.select(exact).exceptAll(late.select(exact)).count() == 0


def test_quarter_totals_add_up(spark, sf_dir):
    expense = V.expense(spark, sf_dir)
    whole = expense.agg(F.sum("amount")).first()[0]
    assert serving.summarize(expense).agg(F.sum("total")).first()[0] == whole


def test_report_parts(spark, sf_dir):
    flagged = quality.flag_issues(V.expense(spark, sf_dir))
    parts = validate.consolidation_report(flagged)
    assert parts["summary"].first().n_rows == flagged.count()
    labels = [r.period for r in parts["periods"].collect()]
    assert labels == sorted(labels, reverse=True)
    assert parts["flags"].first().n >= 1


# --- skew: one id and the blank id hold a third of the rows each --------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    ids = F.when(F.col("id") % 3 == 0, "").when(F.col("id") % 3 == 1, "0" * 13 + "7")
    return spark.range(0, 60_000, 1, 6).select(
        F.lit("f").alias("src_file"),
        ids.otherwise(F.lpad((F.col("id") % 500).cast("string"), 14, "0")).alias("entity_id"),
        F.concat(F.lit("n"), (F.col("id") % 5).cast("string")).alias("entity_name"),
        (F.lit(2000) + F.col("id") % 20).cast("smallint").alias("year"),
        (F.col("id") % 4 + 1).cast("smallint").alias("quarter"),
        F.lit(1).cast("decimal(18,2)").alias("amount"),
    )


@pytest.fixture()
def small_partitions(setting):
    """No broadcast, and partitions of a few KB already count as skewed."""
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20KB")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10KB")


def _final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    execution = df._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    return execution.executedPlan().toString()


def test_hot_key_is_split(spark, skewed, small_partitions):
    registry = spark.range(400).select(
        F.col("id").cast("string").alias("registration"),
        F.lpad(F.col("id").cast("string"), 14, "0").alias("entity_id"),
        F.lit("x").alias("category"),
        (F.col("id") % 3).cast("string").alias("region"),
    )
    done = enrich.enrich(skewed, registry)
    assert done.count() == 60_000
    expected = skewed.join(F.broadcast(registry.select("entity_id")), "entity_id", "left_semi").count()
    assert done.filter(F.col("match_status") == S.MATCHED).count() == expected
    assert "skew=true" in _final_plan(done)


def test_blank_ids_are_spread(spark, skewed):
    key = joins.spread_blank(F.col("entity_id"), ["year", "quarter", "amount"])
    spread = skewed.filter("entity_id = ''").select(key.alias("k")).distinct()
    # the fixture has 20 year and quarter combinations among its blank ids
    assert spread.count() > 10
    assert skewed.filter("entity_id <> ''").filter(key != F.col("entity_id")).count() == 0


def test_hot_file_and_id_keep_their_flags(spark, skewed, small_partitions):
    flagged = quality.flag_issues(skewed)
    assert flagged.count() == 60_000
    blank = flagged.filter("entity_id = ''")
    assert blank.filter(F.contains("issue_flags", F.lit("DIVERGENTE"))).count() == 20_000
    assert "skew=true" in _final_plan(flagged)


def test_hot_groups_are_combined_before_the_shuffle(spark, skewed):
    totals = serving.summarize(skewed)
    assert totals.agg(F.sum("total")).first()[0] == 60_000
    text = totals._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in text[text.index("Exchange"):]
    assert dedupe.keep_first(skewed, ["entity_id"], ["year", "quarter", "entity_name"]).count() == skewed.select("entity_id").distinct().count()
