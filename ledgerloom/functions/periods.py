"""Quarters, period labels and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import matched


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ordinal(year: Column | str, quarter: Column | str) -> Column:
    """A running number of quarters, so that period arithmetic is integer arithmetic."""
    return _col(year).cast("int") * 4 + _col(quarter).cast("int") - 1


def quarters_back(year: Column | str, quarter: Column | str, n: int = 1) -> tuple[Column, Column]:
    """(year, quarter) of the period ``n`` quarters earlier."""
    at = ordinal(year, quarter) - n
    return F.floor(at / 4).cast("int"), (F.pmod(at, F.lit(4)) + 1).cast("int")


def quarter_of(date: Column | str) -> tuple[Column, Column]:
    date = _col(date)
    return F.year(date), F.quarter(date)


def label(year: Column | str, quarter: Column | str) -> Column:
    """'2024/Q3'; NULL when either part is missing."""
    year, quarter = _col(year), _col(quarter)
    return F.concat(year.cast("string"), F.lit("/Q"), quarter.cast("string"))


def parse_date(c: Column | str) -> Column:
    """DD/MM/YYYY or YYYY-MM-DD; other text and impossible dates give NULL."""
    iso = F.regexp_replace(_col(c), r"^([0-9]{2})/([0-9]{2})/([0-9]{4})$", "$3-$2-$1")
    return F.regexp_extract(iso, r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", 0).try_cast("date")


def period_in_name(name: Column | str) -> tuple[Column, Column]:
    """(year, quarter) from names such as '3T2024.zip', '2024/3T/…' or '2024_Q3_…'."""
    name = _col(name)
    packed = r"([1-4])[tT]([0-9]{4})"
    folder = r"([0-9]{4})/([1-4])[tT]/"
    spelled = r"([0-9]{4})[_/-]?[qQ]([1-4])"

    def part(year_group: int, quarter_group: int, pattern: str) -> tuple[Column, Column]:
        return (
            matched(name, pattern, year_group).cast("int"),
            matched(name, pattern, quarter_group).cast("int"),
        )

    found = [part(2, 1, packed), part(1, 2, folder), part(1, 2, spelled)]
    return F.coalesce(*[y for y, _ in found]), F.coalesce(*[q for _, q in found])
