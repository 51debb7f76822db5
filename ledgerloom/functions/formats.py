"""Display formats of money and counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Short units, largest first.
SHORT_UNITS = (("bi", 1_000_000_000), ("mi", 1_000_000), ("mil", 1_000))
MISSING = "-"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _local_separators(shown: Column) -> Column:
    """'1,234.56' -> '1.234,56'."""
    return F.translate(shown, ",.", ".,")


def money(c: Column | str, gap: str = "\u00a0") -> Column:
    """R$ 1.234,56 with two decimals; the sign goes in front; NULL -> '-'."""
    exact = _col(c).cast("decimal(38,2)")
    body = _local_separators(F.format_number(F.abs(exact), 2))
    sign = F.when(exact < 0, F.lit("-")).otherwise(F.lit(""))
    return F.coalesce(F.concat(sign, F.lit(f"R${gap}"), body), F.lit(MISSING))


def number(c: Column | str) -> Column:
    """Thousands with '.', at most three decimals after ',', no trailing zeros."""
    shown = F.format_number(_col(c).cast("decimal(38,3)"), 3)
    trimmed = F.regexp_replace(F.regexp_replace(shown, "0+$", ""), r"\.$", "")
    return F.coalesce(_local_separators(trimmed), F.lit(MISSING))


def short_money(c: Column | str, gap: str = "\u00a0") -> Column:
    """One decimal and a unit by magnitude ('1.2 mi'); small values in full."""
    exact = _col(c).cast("decimal(20,2)")
    size = F.abs(exact)
    shown = None
    for unit, divisor in SHORT_UNITS:
        scaled = F.round(exact / F.lit(divisor).cast("decimal(10,0)"), 1).cast("decimal(20,1)")
        text = F.concat(scaled.cast("string"), F.lit(f" {unit}"))
        condition = size >= divisor
        shown = F.when(condition, text) if shown is None else shown.when(condition, text)
    return shown.otherwise(money(exact, gap))
