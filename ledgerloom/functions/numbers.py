"""Locale-formatted numbers, guarded parses and null-safe ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PLAIN_DECIMAL = r"^-?[0-9]+(\.[0-9]+)?$"
# an optional sign, a fraction and an exponent, with blanks around
ANY_NUMBER = r"^\s*([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,3})?)\s*$"
PLAIN_WHOLE = r"^0*([0-9]{1,18})$"

LARGEST = {"smallint": 2**15 - 1, "int": 2**31 - 1}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def matched(c: Column | str, pattern: str, group: int = 0) -> Column:
    """What a pattern finds, or NULL.

    A cast that fails costs an exception per row even where it is allowed to
    fail, so text is matched first and only cast if that will work.
    """
    return F.nullif(F.regexp_extract(_col(c), pattern, group), F.lit(""))


def _swap_separators(c: Column) -> Column:
    """'1.234,56' -> '1234.56' (one pass: '.' is dropped, ',' becomes '.')."""
    return F.translate(c, ",.", ".")


def comma_decimal(c: Column | str, precision: int = 18, scale: int = 2) -> Column:
    """Files whose every number has comma decimals and dot thousands."""
    return to_decimal(_swap_separators(_col(c)), precision, scale)


def mixed_decimal(c: Column | str, precision: int = 18, scale: int = 2) -> Column:
    """Per value: comma decimals if a comma is present, plain otherwise.

    Only plain digits are accepted after that, so '1e5' or '.5' give NULL.
    """
    c = _col(c)
    plain = F.when(F.contains(c, F.lit(",")), _swap_separators(c)).otherwise(c)
    return plain_decimal(plain, precision, scale)


def plain_decimal(c: Column | str, precision: int = 18, scale: int = 2) -> Column:
    """Digits with an optional fraction, rounded half away from zero; else NULL."""
    return matched(c, PLAIN_DECIMAL).try_cast(f"decimal({precision},{scale})")


def to_decimal(c: Column | str, precision: int = 18, scale: int = 2) -> Column:
    """Coercing parse of text: whatever is not a number becomes NULL."""
    return matched(c, ANY_NUMBER, 1).try_cast(f"decimal({precision},{scale})")


def whole_number(c: Column | str, kind: str = "smallint") -> Column:
    """Digits only; a value too large for the type becomes NULL."""
    above = F.lit(LARGEST[kind] + 1).cast("bigint")
    number = matched(c, PLAIN_WHOLE, 1).cast("bigint")
    return F.nullif(F.least(number, above), above).cast(kind)


def to_whole(c: Column | str) -> Column:
    """Coercing parse of a whole number ('3', ' 3 ', '3.0'); no number gives NULL.

    A number that is no whole number becomes 0 and one beyond the type its largest or smallest
    value, so that range checks see them.  Plain digits, which most values are, are matched and
    cast at once: what follows looks at the text several times.
    """
    number = matched(c, ANY_NUMBER, 1).cast("double")
    largest = float(LARGEST["int"])
    bounded = F.greatest(F.least(number, F.lit(largest)), F.lit(-largest))
    whole = F.when(bounded == F.floor(bounded), bounded).otherwise(0.0)
    # least and greatest pass over NULL
    return F.when(_col(c).rlike("^[0-9]{1,9}$"), _col(c).cast("int")).when(number.isNotNull(), whole.cast("int"))


def ratio(top: Column | str, bottom: Column | str) -> Column:
    """NULL instead of an error when the divisor is zero or NULL."""
    return F.try_divide(_col(top), _col(bottom))


def growth_pct(first: Column | str, last: Column | str) -> Column:
    first, last = _col(first), _col(last)
    return F.round(ratio((last - first) * 100, first), 2)
