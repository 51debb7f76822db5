"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted spellings of a boolean.
TRUE_WORDS = ("true", "t", "1", "yes", "y")
FALSE_WORDS = ("false", "f", "0", "no", "n")
# White space, and what else may follow it at the end of a text.
ENDS = " \t\n\x0b\f\r\x85\u2028\u2029"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_whitespace(c: Column | str) -> Column:
    """Strip every kind of white space (``trim`` removes blanks only).

    Most texts begin and end with something else, and are left as they are without a regular expression.
    """
    c = _col(c).cast("string")
    return F.when(F.btrim(c, F.lit(ENDS)) == c, c).otherwise(F.regexp_replace(c, r"^\s+|\s+$", ""))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(F.trim(_col(c)), F.lit(""))


def nan_to_blank(c: Column | str) -> Column:
    """NULL and the literal text 'nan' become '', the rest is stripped."""
    kept = strip_whitespace(c)
    return F.when(kept.isNull() | (kept == "nan"), F.lit("")).otherwise(kept)


def normal_name(c: Column | str) -> Column:
    """Comparison form of a name: stripped, upper case, single blanks; NULL -> ''."""
    packed = F.regexp_replace(strip_whitespace(c), " {2,}", " ")
    return F.coalesce(F.upper(packed), F.lit(""))


def is_blank_name(c: Column | str, any_case: bool = True) -> Column:
    """NULL, white space only, or the literal text 'nan'."""
    kept = F.coalesce(strip_whitespace(c), F.lit(""))
    return (F.lower(kept) if any_case else kept).isin("", "nan")


def contains_any(c: Column | str, words: tuple[str, ...]) -> Column:
    """Case-insensitive: at least one of the words occurs; NULL -> false."""
    folded = F.lower(_col(c))
    found = F.lit(False)
    for word in words:
        found = found | F.contains(folded, F.lit(word.lower()))
    return F.coalesce(found, F.lit(False))


def parse_boolean(c: Column | str) -> Column:
    word = F.lower(_col(c))
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))


def split_flags(c: Column | str) -> Column:
    return F.filter(F.split(_col(c), ";"), lambda flag: flag != "")
