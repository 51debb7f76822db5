from datetime import date
from decimal import Decimal as D

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.functions import formats, ids, numbers, periods, text

ID_CASES = ["12.345.678/0001-90", "  123  ", "", None, "abc", "1" * 15]


def test_digits_only(values):
    assert values(ids.digits_only("v"), ID_CASES) == ["12345678000190", "123", "", "", "", "1" * 15]


def test_padded_id_never_cuts(values):
    done = values(ids.padded_id("v"), ID_CASES)
    assert done == ["12345678000190", "00000000000123", "", "", "", "1" * 15]


def test_format_id(values):
    done = values(ids.format_id("v"), ["12345678000190", "123", "12.345.678/0001-90"])
    assert done == ["12.345.678/0001-90", "123", "12.345.678/0001-90"]


def test_check_digits(values):
    cases = ["11222333000181", "11222333000182", "11111111111111", "00000000000000", "123", "", None]
    assert values(ids.has_valid_check_digits("v"), cases) == [True] + [False] * 6


def test_check_digits_of_junk_does_not_raise(values):
    assert values(ids.has_valid_check_digits("v"), ["x" * 14, "1122233300018x", "9" * 30]) == [False] * 3


def test_format_problem(values):
    done = values(ids.format_problem("v"), ["", None, "123", "0" * 14, "11222333000181"])
    assert done == [
        "CNPJ vazio",
        "CNPJ vazio",
        "CNPJ deve ter 14 dígitos. Recebido: 3",
        "CNPJ não pode ser zerado",
        "",
    ]


def test_registration_key(values):
    assert values(ids.registration_key("v"), ["007", " 7 ", "0", "000", "70"]) == ["7", "7", "0", "0", "70"]


def _with_check_digits(base):
    """Independent computation over the digits of a 12-digit base."""
    digits = [int(c) for c in base]
    for length in (12, 13):
        weights = [2 + i % 8 for i in range(length)][::-1]
        rest = sum(d * w for d, w in zip(digits, weights)) % 11
        digits.append(0 if rest < 2 else 11 - rest)
    return "".join(map(str, digits))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(1, 10**12 - 1), min_size=20, max_size=50))
def test_generated_ids_pass(values, bases):
    whole = [_with_check_digits(f"{b:012d}") for b in bases]
    whole = [w for w in whole if len(set(w)) > 1]
    assert all(values(ids.has_valid_check_digits("v"), whole))
    wrong = [w[:13] + str((int(w[13]) + 1) % 10) for w in whole]
    assert not any(values(ids.has_valid_check_digits("v"), wrong))


NUMBERS = ["1.234,56", "100.50", "-1", "1e5", ".5", "", None, "abc", "2.345", "-2.345"]


def test_comma_decimal(values):
    done = values(numbers.comma_decimal("v"), NUMBERS)
    assert done[:3] == [D("1234.56"), D("10050.00"), D("-1.00")]
    assert done[5:8] == [None, None, None]


def test_mixed_decimal(values):
    assert values(numbers.mixed_decimal("v"), NUMBERS) == [
        D("1234.56"),
        D("100.50"),
        D("-1.00"),
        None,
        None,
        None,
        None,
        None,
        D("2.35"),
        D("-2.35"),
    ]


def test_to_decimal(values):
    done = values(numbers.to_decimal("v"), NUMBERS)
    assert done[0] is None and done[1] == D("100.50") and done[3] == D("100000.00")


def test_whole_number(values):
    assert values(numbers.whole_number("v"), ["3", "-3", "3.0", "99999", "", None]) == [
        3,
        None,
        None,
        None,
        None,
        None,
    ]


def test_whole_numbers_from_leading_zeros_and_limits(values):
    assert values(numbers.whole_number("v"), ["007", "0", "32767", "32768", "9" * 30]) == [7, 0, 32767, None, None]
    assert values(numbers.whole_number("v", "int"), ["99999"]) == [99999]


def test_to_whole(values):
    given = [" 3 ", "3.0", "-1", "99999", "T1", "", None, "3.5", "99999999999", "1e400"]
    largest = 2**31 - 1
    assert values(numbers.to_whole("v"), given) == [3, 3, -1, 99999, None, None, None, 0, largest, largest]


def test_to_decimal_shapes(values):
    cases = [" 1.5 ", "+2", ".5", "5.", "1e2", "1E-1", "1,5", "--1", "e5", ".", "9" * 20]
    assert values(numbers.to_decimal("v"), cases) == [
        D("1.50"),
        D("2.00"),
        D("0.50"),
        D("5.00"),
        D("100.00"),
        D("0.10"),
        None,
        None,
        None,
        None,
        None,
    ]


def test_growth_and_ratio(spark):
    df = spark.createDataFrame(
        [(D("100.50"), D("300.00")), (D("0.00"), D("1.00"))],
        "a decimal(38,2), b decimal(38,2)",
    )
    done = df.select(numbers.growth_pct("a", "b").alias("g"), numbers.ratio("b", "a").alias("r"))
    first, second = done.collect()
    assert first.g == D("198.51") and second.g is None and second.r is None


def test_strip_and_blank(values):
    cases = ["\t a b \n", "  ", None, "nan"]
    assert values(text.strip_whitespace("v"), cases) == ["a b", "", None, "nan"]
    assert values(text.blank_to_null("v"), ["  ", " a ", None]) == [None, "a", None]
    assert values(text.nan_to_blank("v"), cases) == ["a b", "", "", ""]


def test_normal_name(values):
    assert values(text.normal_name("v"), [" a   b  c ", None, ""]) == ["A B C", "", ""]


def test_blank_name(values):
    assert values(text.is_blank_name("v"), ["", " ", "NaN", None, "ab"]) == [True] * 4 + [False]


def test_contains_any_takes_words_literally(values):
    found = text.contains_any("v", ("evento", "a.c"))
    assert values(found, ["EVENTOS", "abc", "xA.Cx", None]) == [True, False, True, False]


def test_parse_boolean(values):
    cases = ["TRUE", "t", "1", "Yes", "y", "false", "F", "0", "no", "N", "maybe", None]
    assert values(text.parse_boolean("v"), cases) == [True] * 5 + [False] * 5 + [None, None]


def test_split_flags(values):
    assert values(text.split_flags("v"), ["A;B", "", "A;"]) == [["A", "B"], [], ["A"]]


def test_dates(values):
    cases = ["05/03/2020", "2020-03-05", "31/02/2020", "x", "5/3/2020"]
    assert values(periods.parse_date("v"), cases) == [date(2020, 3, 5)] * 2 + [None] * 3


def test_quarters_back(spark):
    df = spark.createDataFrame([(2025, 1)], "y int, q int")
    for n, expected in ((0, (2025, 1)), (1, (2024, 4)), (2, (2024, 3)), (5, (2023, 4)), (9, (2022, 4))):
        assert tuple(df.select(*periods.quarters_back("y", "q", n)).first()) == expected


def test_period_names(values):
    year, quarter = periods.period_in_name("v")
    cases = ["3T2024.zip", "/x/2024/3T/f.csv", "2024_Q3_3T2024.zip", "2023Q1.csv", "notes.pdf"]
    assert values(year, cases) == [2024, 2024, 2024, 2023, None]
    assert values(quarter, cases) == [3, 3, 3, 1, None]


def test_period_label(spark):
    row = spark.range(1).select(
        periods.label(F.lit(2024), F.lit(3)).alias("a"),
        periods.label(F.lit(None).cast("int"), F.lit(3)).alias("b"),
    ).first()
    assert row.a == "2024/Q3" and row.b is None


def test_money_formats(values):
    cases = [D("1234.56"), D("-0.50"), D("1250000.00"), D("2500000000.00"), D("999.99"), None]
    gap = "\u00a0"
    full = values(formats.money("v"), cases, "decimal(18,2)")
    assert full == [
        f"R${gap}1.234,56",
        f"-R${gap}0,50",
        f"R${gap}1.250.000,00",
        f"R${gap}2.500.000.000,00",
        f"R${gap}999,99",
        "-",
    ]
    short = values(formats.short_money("v"), cases, "decimal(18,2)")
    assert short == ["1.2 mil", f"-R${gap}0,50", "1.3 mi", "2.5 bi", f"R${gap}999,99", "-"]


def test_number_format(values):
    cases = [D("1234567.000"), D("1234.500"), D("100.000"), None]
    assert values(formats.number("v"), cases, "decimal(18,3)") == ["1.234.567", "1.234,5", "100", "-"]


def test_white_space_is_stripped_as_by_the_regular_expression(values):
    texts = [None, "", " ", "a", " a", "a\t\n", "a \x85", "\x85a", "a  ", "  a  ", "a b", "\x0ba\x0c", "a\xa0", "a \r\n"]
    by_pattern = values(F.regexp_replace("v", r"^\s+|\s+$", ""), texts)
    assert values(text.strip_whitespace("v"), texts) == by_pattern
