"""Row predicates and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import schema as S
from ledgerloom.functions import ids, text


def ledger_lines(df: DataFrame, column: str, words: tuple[str, ...] = S.LEDGER_WORDS) -> DataFrame:
    """Lines whose description names one of the words, in any case."""
    return df.filter(text.contains_any(column, words))


def countable_amounts(df: DataFrame, amount: str = "amount") -> DataFrame:
    """Amounts that are present and not negative."""
    return df.filter(F.col(amount) >= 0)


def full_length_ids(df: DataFrame, column: str = "entity_id") -> DataFrame:
    return df.filter(F.length(column) == ids.ID_LENGTH)


def loadable() -> Column:
    """What the typed expense table accepts; never NULL."""
    accepted = (
        (F.length("entity_id") == ids.ID_LENGTH)
        & F.col("quarter").between(1, 4)
        & F.col("year").between(S.FIRST_YEAR, S.LAST_YEAR)
        & F.col("entity_name").isNotNull()
    )
    return F.coalesce(accepted, F.lit(False))


def split_by(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected); together they are the input."""
    return df.filter(condition), df.filter(~condition)


def entity(df: DataFrame, entity_id: str) -> DataFrame:
    """Rows of one entity; the argument may be formatted or unpadded."""
    wanted = ids.padded_id(F.lit(entity_id))
    return df.filter(F.col("entity_id") == wanted)


def matches_search(search: str, regex: bool = False) -> Column:
    """Id or name search.

    The id side compares the digits typed (a partial id is enough); a search
    without digits has no id side.  The name side is literal unless ``regex``.
    """
    digits = "".join(ch for ch in search if ch in "0123456789")
    if regex:
        by_name = F.col("entity_name").rlike(f"(?i){search}")
    else:
        by_name = text.contains_any("entity_name", (search,))
    by_name = F.coalesce(by_name, F.lit(False))
    return F.contains(F.col("entity_id"), F.lit(digits)) | by_name if digits else by_name


def active_ids(df: DataFrame) -> DataFrame:
    """Distinct non-empty ids with a marker column."""
    return (
        df.select("entity_id")
        .filter(F.col("entity_id") != "")
        .distinct()
        .withColumn("has_data", F.lit(True))
    )
