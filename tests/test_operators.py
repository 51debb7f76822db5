from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerloom import schema as S
from ledgerloom.operators import columns as C
from ledgerloom.operators import dedupe, filters, joins, quality, ranking, stats

EXPENSE = (
    "src_file string, entity_id string, entity_name string, "
    "quarter smallint, year smallint, amount decimal(18,2)"
)


@pytest.fixture(scope="module")
def flag_frame(spark):
    return spark.createDataFrame(
        [
            ("a", "", "", 4, 2022, D(0)),
            ("a", "11222333000181", "Gama Vida", 1, 2019, D("-7.5")),
            ("a", "11222333000181", "Outra", 5, 1999, None),
            ("b", "11222333000181", "Outra", 1, 2031, D(5)),
            ("b", "0" * 14, None, None, None, D(5)),
            ("b", "123", "nan", 0, 2000, D(5)),
        ],
        EXPENSE,
    )


def _flags(df):
    return [r.issue_flags for r in df.collect()]


def test_flags_in_fixed_order(flag_frame):
    done = {(r.src_file, r.entity_id, r.entity_name): r.issue_flags for r in quality.flag_issues(flag_frame).collect()}
    assert done["a", "", ""] == "RAZAO_VAZIA;CNPJ_SEM_MATCH;CNPJ_INVALIDO;VALOR_ZERADO"
    assert done["a", "11222333000181", "Gama Vida"] == "VALOR_NEGATIVO;CNPJ_RAZAO_DIVERGENTE"
    assert (
        done["a", "11222333000181", "Outra"]
        == "VALOR_NULO;TRIMESTRE_INVALIDO;ANO_INVALIDO;CNPJ_RAZAO_DIVERGENTE"
    )
    assert done["b", "11222333000181", "Outra"] == "ANO_INVALIDO"
    # an unknown period raises no flag
    assert done["b", "0" * 14, None] == "RAZAO_VAZIA;CNPJ_INVALIDO"
    assert done["b", "123", "nan"] == "RAZAO_VAZIA;CNPJ_INVALIDO;TRIMESTRE_INVALIDO"


def test_divergence_over_all_files(flag_frame):
    done = quality.flag_issues(flag_frame, scope=("entity_id",))
    assert done.filter(F.contains("issue_flags", F.lit("DIVERGENTE"))).count() == 3


def test_divergence_same_with_and_without_broadcast(flag_frame, setting):
    wide = sorted(_flags(quality.flag_issues(flag_frame)))
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert sorted(_flags(quality.flag_issues(flag_frame))) == wide


def test_empty_input(spark):
    empty = spark.createDataFrame([], EXPENSE)
    assert quality.flag_issues(empty).count() == 0
    report = quality.count_checks(empty, {"x": F.col("amount").isNull()}).first()
    assert report.n == 0 and report.pct is None
    assert stats.exact_median(empty, "amount").first().median is None
    assert quality.flag_histogram(quality.flag_issues(empty)).count() == 0


def test_all_ids_invalid(spark):
    df = spark.createDataFrame([("x",), ("",), (None,)], "entity_id string")
    done = quality.id_validity(df).collect()
    assert [r.id_valid for r in done] == [False] * 3
    assert {r.id_invalid_reason for r in done} == {"FORMATO_INVALIDO"}


def test_id_reasons(spark):
    df = spark.createDataFrame([("11.222.333/0001-81",), ("11222333000182",), ("1",)], "entity_id string")
    done = [r.id_invalid_reason for r in quality.id_validity(df).collect()]
    assert done == ["", "DIGITOS_VERIFICADORES_INVALIDOS", "FORMATO_INVALIDO"]


def test_amount_name_period_validity(flag_frame):
    checked = quality.period_validity(quality.name_validity(quality.amount_validity(flag_frame)))
    rows = {(r.src_file, r.entity_name): r for r in checked.collect()}
    zero = rows["a", ""]
    assert zero.amount_valid and zero.amount_zero and zero.name_empty and zero.name_short
    assert not rows["a", "Gama Vida"].amount_valid
    assert rows["a", "Outra"].amount_null and not rows["a", "Outra"].amount_valid
    # an unknown period is invalid here
    assert not rows["b", None].quarter_valid and not rows["b", None].year_valid
    assert rows["b", "nan"].name_empty and not rows["b", "nan"].name_short


def test_flag_histogram(flag_frame):
    done = {r.flag: r.n for r in quality.flag_histogram(quality.flag_issues(flag_frame)).collect()}
    assert done["RAZAO_VAZIA"] == 3 and done["CNPJ_RAZAO_DIVERGENTE"] == 2


def test_constraints(flag_frame):
    keys = quality.duplicate_keys(flag_frame, ["entity_id"]).collect()
    assert [(r.entity_id, r.n) for r in keys] == [("11222333000181", 3)]
    nulls = quality.null_violations(flag_frame, ["entity_name", "year", "src_file"])
    assert {(r.column, r.n) for r in nulls.collect()} == {("entity_name", 1), ("year", 1)}
    with pytest.raises(ValueError, match="repeats keys"):
        quality.require_unique(flag_frame, ["entity_id"])


# --- columns -------------------------------------------------------------------------


def test_alias_headers(spark):
    raw = spark.createDataFrame(
        [("1", "A", "3", "2024", "5,0", "x")],
        [" CD_CNPJ ", "Nm Razao Social", "TRI", "ANO_COMPETENCIA", "Vl Despesa", "other"],
    )
    assert C.apply_aliases(raw, S.EXPENSE_ALIASES).columns == list(S.EXPENSE_ALIASES)


def test_clashing_headers(spark):
    raw = spark.createDataFrame([("1", "2", "3")], ["cnpj", "eventos", "sinistros"])
    with pytest.raises(C.AmbiguousColumns, match="eventos"):
        C.apply_aliases(raw, S.EXPENSE_ALIASES)


def test_unknown_headers_are_kept(spark):
    raw = spark.createDataFrame([("1", "2")], ["Foo Bar", "baz"])
    assert C.apply_aliases(raw, S.EXPENSE_ALIASES).columns == ["foo_bar", "baz"]


def test_complete_and_export(spark):
    raw = spark.createDataFrame([("x", "1")], ["extra", "year"])
    full = C.complete_columns(raw)
    assert full.columns == [*S.EXPENSE_COLUMNS, "extra"]
    assert full.first().entity_id is None
    out = S.export_projection(full, ["year"], ["issue_flags"])
    assert out.first().asDict() == {"year": "1", "issue_flags": ""}
    with pytest.raises(ValueError, match="lacks the columns"):
        S.export_projection(raw, ["entity_id"])


def test_add_if_absent(spark):
    df = spark.createDataFrame([(2024,)], "year int")
    done = C.add_if_absent(df, {"year": F.lit(1), "quarter": F.lit(2)}).first()
    assert (done.year, done.quarter) == (2024, 2)


def test_serving_aliases_spellings():
    aliases = S.SERVING_ALIASES
    assert aliases["registration"] == (
        "registro_ans",
        "registroans",
        "registro_operadora",
        "registro_operadora_ans",
    )
    spelled = [a for names in aliases.values() for a in names]
    assert "valordespesas" in spelled and "alta_variabilidade" in spelled
    assert len(spelled) == len(set(spelled))


# --- filters ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [("00000000000123", "Alfa (1)"), ("00000000004567", "beta"), ("", None)],
        "entity_id string, entity_name string",
    )


@pytest.mark.parametrize(
    ("search", "regex", "hits"),
    [("ALF", False, 1), ("(1)", False, 1), ("0123", False, 1), ("^b", True, 1), ("^b", False, 0), (".", False, 0)],
)
def test_search(people, search, regex, hits):
    assert people.filter(filters.matches_search(search, regex)).count() == hits


def test_entity_accepts_formatted_ids(people):
    assert filters.entity(people, "123").count() == 1
    assert filters.entity(people, "00.000.000/0045-67").count() == 1
    assert filters.entity(people, "9").count() == 0


def test_split_keeps_every_row(spark):
    rows = [("1" * 14, "A", 1, 2024), ("1", "A", 1, 2024), ("1" * 14, None, 1, 2024), ("1" * 14, "A", None, 2024)]
    df = spark.createDataFrame(rows, "entity_id string, entity_name string, quarter int, year int")
    good, bad = filters.split_by(df, filters.loadable())
    assert (good.count(), bad.count()) == (1, 3)


def test_active_ids(people):
    assert {r.entity_id for r in filters.active_ids(people).collect()} == {"00000000000123", "00000000004567"}


# --- keep first / last, union, joins ---------------------------------------------------


def test_keep_first_and_last(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("a", None, "z"), ("b", 1, "w")], "k string, n int, v string")
    first = {r.k: r.v for r in dedupe.keep_first(df, ["k"], [F.col("n").asc_nulls_last()]).collect()}
    last = {r.k: r.v for r in dedupe.keep_last(df, ["k"], ["n"]).collect()}
    assert first == {"a": "y", "b": "w"} and last["b"] == "w"


def test_union_aligned(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2.0)], "b string, c double")
    done = dedupe.union_aligned([a, b])
    assert done.columns == ["a", "b", "c"] and done.count() == 2


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_lookup_keeps_all_rows(spark, setting, threshold):
    setting("spark.sql.autoBroadcastJoinThreshold", threshold)
    rows = spark.createDataFrame(
        [("a", 1), ("", 2), (None, 3), ("zz", 4), ("a", 5)], "k string, amount int"
    )
    table = spark.createDataFrame([("a", "A"), ("", "blank"), (None, "null"), ("c", "C")], "t string, label string")
    done = joins.lookup(rows, table, F.col("k"), F.col("t"), ["label"], hit="hit")
    got = {r.amount: (r.label, r.hit) for r in done.collect()}
    assert got == {1: ("A", True), 2: (None, False), 3: (None, False), 4: (None, False), 5: ("A", True)}


def test_the_planner_decides_by_the_size_of_a_stored_side(spark, setting):
    def joined():
        side = joins.sized_side(spark.range(5000).withColumnRenamed("id", "k"), "t")
        rows = spark.range(5000).withColumnRenamed("id", "k")
        return rows.join(side, "k")._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" in joined()
    setting("spark.sql.autoBroadcastJoinThreshold", "1000")
    assert "BroadcastHashJoin" not in joined()


# --- statistics --------------------------------------------------------------------------


@pytest.mark.parametrize("numbers", [[5], [1, 2], [3, 1, 2], [4, 4, 4, 1], [1, 1, 2, 2], list(range(1001)), [0] * 500 + [9] * 499])
def test_exact_median(spark, numbers):
    import statistics as st

    df = spark.createDataFrame([(D(n),) for n in numbers] + [(None,)], "x decimal(18,2)")
    assert stats.exact_median(df.repartition(5), "x").first().median == st.median(numbers)


def test_quarter_statistics_edge_groups(spark):
    df = spark.createDataFrame(
        [("one", 2024, 1, D(7)), ("zero", 2024, 1, D(0)), ("zero", 2024, 2, D(0)), ("two", 2024, 1, D(1)),
         ("two", 2024, 1, D(2)), ("two", 2024, 2, D(9)), ("none", None, 1, D(9))],
        "g string, year int, quarter int, amount decimal(18,2)",
    )
    totals = stats.period_totals(df, ["g"])
    done = {r.g: r for r in stats.quarter_statistics(totals, ["g"]).collect()}
    assert set(done) == {"one", "zero", "two"}
    assert done["one"].std == 0 and done["one"].n_quarters == 1 and done["one"].cv_pct == 0
    assert done["zero"].cv_pct is None and done["zero"].high_variability is False
    assert done["two"].total == D("12.00") and done["two"].mean == 6.0
    assert abs(done["two"].std - 18**0.5) < 1e-12 and done["two"].high_variability
    bands = stats.variability_bands(stats.quarter_statistics(totals, ["g"])).first()
    assert (bands.low, bands.medium, bands.high) == (1, 0, 1)


def test_bands_are_inclusive(spark):
    df = spark.createDataFrame([(24.9,), (25.0,), (50.0,), (50.1,), (None,)], "cv_pct double")
    assert tuple(stats.variability_bands(df).first()) == (1, 2, 1)


def test_fixed_domain_frequency(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "s string")
    done = {r.s: (r.n, r.pct) for r in stats.fixed_domain_frequency(df, "s", ["a", "c"]).collect()}
    assert done["a"][0] == 2 and done["c"] == (0, 0.0)


# --- positions and pages -------------------------------------------------------------------


def test_global_position_over_many_partitions(spark, setting):
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    setting("spark.sql.shuffle.partitions", "7")
    df = spark.range(0, 5000, 1, 9).select("id", (F.col("id") * 7919 % 5003).alias("v"))
    done = ranking.with_global_position(df, [F.col("v").desc(), "id"], "place").collect()
    ordered = sorted(done, key=lambda r: r.place)
    assert [r.place for r in ordered] == list(range(1, 5001))
    assert [r.v for r in ordered] == sorted((r.v for r in done), reverse=True)


def test_global_position_with_one_hot_value(spark):
    df = spark.range(0, 3000, 1, 6).select("id", F.lit(1).alias("v"))
    done = ranking.with_global_position(df, [F.col("v").desc(), "id"], "place")
    assert done.filter("place = id + 1").count() == 3000


def test_pages(spark):
    df = spark.range(100).select(F.col("id").alias("n"))
    assert [r.n for r in ranking.page(df, ["n"], 3, 20).collect()] == list(range(40, 60))
    assert ranking.page(df, ["n"], 6, 20).count() == 0
    for number, size in ((0, 20), (1, 0), (1, 201)):
        with pytest.raises(ValueError):
            ranking.page(df, ["n"], number, size)


def test_page_count(spark):
    df = spark.createDataFrame([(0,), (1,), (20,), (21,)], "n long")
    assert [r[0] for r in df.select(ranking.page_count("n", 20)).collect()] == [1, 1, 1, 2]


def test_leader_skips_the_sentinel(spark):
    df = spark.createDataFrame([("NÃO_INFORMADO", 9), ("A", 5), ("B", 7)], "region string, total int")
    assert ranking.leader(df, "region", "total", S.UNKNOWN).first().region == "B"
    alone = df.filter("total = 9")
    assert ranking.leader(alone, "region", "total", S.UNKNOWN).first().region == S.UNKNOWN


def test_top_k_leaves_out_nulls(spark):
    df = spark.createDataFrame([("a", None), ("b", 2), ("c", 2), ("d", 1)], "k string, n int")
    assert [r.k for r in ranking.top_k(df, "n", 2, ["k"]).collect()] == ["b", "c"]


def test_counters_ride_along(spark):
    from ledgerloom.operators import counters

    df = spark.createDataFrame([(1,), (1,), (2,)], "n int")
    rows, before = counters.observed(df, "before")
    unique, after = counters.observed(dedupe.distinct_rows(rows), "after")
    assert len(unique.collect()) == 2
    assert counters.removed(before, after) == {"n_before": 3, "n_after": 2, "n_removed": 1}


def test_links_of_a_listing(spark):
    from ledgerloom.functions import periods
    from ledgerloom.sources import landing

    html = '<a href="2024/">2024</a> <a href="3T2024.zip">x</a> <a href="/p/2023/1T/">y</a>'
    links = spark.createDataFrame([(html,)], "t string").select(F.explode(landing.listed_links("t")).alias("link"))
    year, quarter = periods.period_in_name("link")
    got = [tuple(r) for r in links.select("link", year, quarter).collect()]
    assert got == [("2024/", None, None), ("3T2024.zip", 2024, 3), ("/p/2023/1T/", 2023, 1)]


def test_intermediates_can_be_dropped(spark):
    from pathlib import Path

    from ledgerloom import session

    df = session.materialize(spark.range(3), "t")
    folder = Path(session._application_folder(spark).removeprefix("file:"))
    assert df.count() == 3 and folder.exists()
    assert session.drop_intermediates(spark) and not folder.exists()
