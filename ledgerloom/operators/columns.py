"""Header normalisation, alias mapping and projections."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import schema as S


class AmbiguousColumns(ValueError):
    """Two source columns claim the same standard column."""


def clean_header(name: str, join_words: bool = True) -> str:
    name = name.strip().lower().removeprefix("\ufeff").strip()
    return name.replace(" ", "_") if join_words else name


def alias_lookup(aliases: Mapping[str, Iterable[str]]) -> dict[str, str]:
    return {alias: column for column, names in aliases.items() for alias in names}


def apply_aliases(
    df: DataFrame,
    aliases: Mapping[str, Iterable[str]],
    *,
    join_words: bool = True,
    keep_unmapped: bool = False,
) -> DataFrame:
    """Rename accepted headers to standard columns and keep only those.

    When no header is known the frame is returned whole, with cleaned headers.
    """
    lookup = alias_lookup(aliases)
    headers = [clean_header(c, join_words) for c in df.columns]
    targets = [lookup.get(h, h) for h in headers]
    for column in aliases:
        sources = [h for h, t in zip(headers, targets) if t == column]
        if len(sources) > 1:
            raise AmbiguousColumns(f"{column} is given by several columns: {sources}")
    renamed = df.toDF(*targets)
    known = [c for c in aliases if c in targets]
    if keep_unmapped or not known:
        return renamed
    return renamed.select(*known)


def complete_columns(df: DataFrame, standard: Iterable[str] = S.EXPENSE_COLUMNS) -> DataFrame:
    """Standard columns first (NULL when absent), all others after them."""
    standard = list(standard)
    first = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in standard]
    return df.select(*first, *[c for c in df.columns if c not in standard])


def add_if_absent(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """Provenance or evolved columns; an existing column is left alone."""
    return df.withColumns({name: value for name, value in values.items() if name not in df.columns})


def blank_nulls(df: DataFrame) -> DataFrame:
    """NULL -> '' on text columns, for output."""
    return df.na.fill("")


def fill_unknown(df: DataFrame, columns: Iterable[str], label: str = S.UNKNOWN) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(label)) for c in columns})
