"""Issue flags, validity columns, constraints and quality reports."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import schema as S
from ledgerloom.functions import ids, text
from ledgerloom.operators import joins

# Divergent keys that a task may hold whole; more of them are joined by a shuffle.
HELD_KEYS = 1 << 16

# --- issue flags ---------------------------------------------------------------


def _flag(condition: Column, label: str) -> Column:
    return F.when(condition, F.lit(label))


def row_flags(id_col: str = "entity_id") -> list[Column]:
    """Flags that need only the row itself, in their fixed order.

    A NULL quarter or year raises no flag; the validity columns treat it as
    invalid.
    """
    amount, quarter, year = F.col("amount"), F.col("quarter"), F.col("year")
    return [
        _flag(text.is_blank_name("entity_name"), S.FLAG_BLANK_NAME),
        _flag(F.col(id_col) == "", S.FLAG_BLANK_ID),
        _flag(ids.format_problem(id_col) != "", S.FLAG_BAD_ID),
        _flag(amount.isNull(), S.FLAG_NULL_AMOUNT),
        _flag(amount < 0, S.FLAG_NEGATIVE_AMOUNT),
        _flag(amount == 0, S.FLAG_ZERO_AMOUNT),
        _flag((quarter < 1) | (quarter > 4), S.FLAG_BAD_QUARTER),
        _flag((year < S.FIRST_YEAR) | (year > S.LAST_YEAR), S.FLAG_BAD_YEAR),
    ]


def divergent_ids(df: DataFrame, scope: Iterable[str]) -> DataFrame:
    """Keys under which more than one name occurs.

    The names of a key are compared by 128 bits that stand for each: their least and greatest are
    kept by a hash aggregate with map-side combine, one row a key, where a minimum and
    maximum of texts would sort all rows.
    """
    scope, name = list(scope), F.col("entity_name")
    bits = {"_a": F.xxhash64(name), "_b": F.xxhash64(F.lit(7), name)}
    names = df.filter(name.isNotNull()).select(*scope, *[c.alias(k) for k, c in bits.items()])
    spans = names.groupBy(*scope).agg(*[f(k).alias(f"{k}{at}") for k in bits for at, f in ((0, F.min), (1, F.max))])
    return spans.filter("_a0 <> _a1 OR _b0 <> _b1").select(*scope)


def flag_issues(
    df: DataFrame,
    scope: Iterable[str] = ("src_file", "entity_id"),
    spread: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """Add ``issue_flags``: every issue of the row, joined by ';', '' if none.

    ``scope`` says within what the names of one id must agree: one file by
    default, ``("entity_id",)`` for the whole input.  The divergent keys are
    computed when this is called; while they are few, the rows stay in place.
    Both read ``df``, so pass a stored table.  ``spread`` deals its rows out before they
    are grouped; rows that the join deals out by their keys are not dealt out twice.
    """
    scope = list(scope)
    dealt = spread(df)
    divergent = joins.sized_side(divergent_ids(dealt, scope), "divergent")
    if divergent.count() > HELD_KEYS:  # long paths take little room in files, but much in memory
        divergent = divergent.hint("shuffle_hash")  # each task holds its share, and the rows need no sort
        dealt = df
    marked = dealt.join(divergent.withColumn("_divergent", F.lit(True)), scope, "left")
    flags = F.concat_ws(
        ";", *row_flags(), _flag(F.col("_divergent"), S.FLAG_DIVERGENT_NAME)
    )
    return marked.select(*df.columns, flags.alias("issue_flags"))


# --- validity columns ------------------------------------------------------------


def id_validity(df: DataFrame, id_col: str = "entity_id") -> DataFrame:
    """Clean the id and add its format, check-digit and overall validity."""
    cleaned = df.withColumn(id_col, ids.digits_only(id_col))
    numbered = cleaned.withColumn("_number", ids.id_number(id_col))
    checked = numbered.withColumns(
        {
            "id_format_valid": F.coalesce(F.col("_number") > 0, F.lit(False)),
            "id_digits_valid": ids.check_digits_agree("_number"),
        }
    ).drop("_number")
    return checked.withColumns(
        {
            "id_valid": F.col("id_format_valid") & F.col("id_digits_valid"),
            "id_invalid_reason": ids.invalid_reason(
                F.col("id_format_valid"), F.col("id_digits_valid")
            ),
        }
    )


def id_format_check(df: DataFrame, id_col: str = "entity_id") -> DataFrame:
    """The format check alone: is a cleaned id usable, and if not, why."""
    problem = ids.format_problem(id_col)
    return df.withColumn("id_problem", problem).withColumn("id_ok", F.col("id_problem") == "")


def amount_validity(df: DataFrame) -> DataFrame:
    amount = F.col("amount")
    return df.withColumns(
        {
            "amount_null": amount.isNull(),
            "amount_negative": F.coalesce(amount < 0, F.lit(False)),
            "amount_zero": F.coalesce(amount == 0, F.lit(False)),
            "amount_valid": F.coalesce(amount >= 0, F.lit(False)),
        }
    )


def name_validity(df: DataFrame) -> DataFrame:
    """A NULL name is empty and too short; the literal 'nan' is empty."""
    kept = F.coalesce(text.strip_whitespace("entity_name"), F.lit(""))
    empty, short = kept.isin("", "nan"), F.length(kept) < 3
    return df.withColumns(
        {"name_empty": empty, "name_short": short, "name_valid": ~(empty | short)}
    )


def period_validity(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "quarter_valid": F.coalesce(F.col("quarter").between(1, 4), F.lit(False)),
            "year_valid": F.coalesce(
                F.col("year").between(S.FIRST_YEAR, S.LAST_YEAR), F.lit(False)
            ),
        }
    )


# --- reports ---------------------------------------------------------------------


def count_checks(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(check, n, pct) from one pass; pct is NULL on empty input."""
    totals = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(condition).alias(name) for name, condition in checks.items()],
    )
    pairs = F.array(
        *[F.struct(F.lit(name).alias("check"), F.col(name).alias("n")) for name in checks]
    )
    return totals.select("_rows", F.inline(pairs)).select(
        "check", "n", F.try_divide(F.col("n") * F.lit(100.0), F.col("_rows")).alias("pct")
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequencies of the non-NULL values, most frequent first."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), column)
    )


def flag_histogram(df: DataFrame, flags: str = "issue_flags") -> DataFrame:
    """How often each flag occurs.

    Rows are counted per distinct flag combination first, so that only those
    few combinations are exploded.
    """
    combos = df.filter(F.col(flags) != "").groupBy(flags).agg(F.count(F.lit(1)).alias("_n"))
    return (
        combos.select(F.explode(text.split_flags(flags)).alias("flag"), "_n")
        .groupBy("flag")
        .agg(F.sum("_n").alias("n"))
        .orderBy(F.desc("n"), "flag")
    )


# --- constraints -------------------------------------------------------------------


def duplicate_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    keys = list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def null_violations(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """(column, n) for NOT NULL columns that hold NULLs, from one pass."""
    counted = count_checks(df, {c: F.col(c).isNull() for c in columns})
    return counted.filter("n > 0").select(F.col("check").alias("column"), "n")


def require_unique(df: DataFrame, keys: Iterable[str], what: str = "batch") -> None:
    keys = list(keys)
    clash = duplicate_keys(df, keys).limit(3).collect()
    if clash:
        raise ValueError(f"{what} repeats keys {keys}: {[tuple(r)[:-1] for r in clash]}")
