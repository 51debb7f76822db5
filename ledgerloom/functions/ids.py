"""Entity identifiers: cleaning, format and check digits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom import schema as S
from ledgerloom.functions.numbers import matched

ID_LENGTH = 14
ZERO_ID = "0" * ID_LENGTH

# Weights of the two check digits (modulus 11).
FIRST_WEIGHTS = (5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)
SECOND_WEIGHTS = (6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)

# Texts of the format check.
EMPTY_TEXT = "CNPJ vazio"
LENGTH_TEXT = "CNPJ deve ter 14 dígitos. Recebido: "
ZERO_TEXT = "CNPJ não pode ser zerado"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def digits_only(c: Column | str) -> Column:
    """Keep the digits; NULL and digit-free text become ''."""
    return F.coalesce(F.regexp_replace(_col(c).cast("string"), "[^0-9]", ""), F.lit(""))


def padded_id(c: Column | str) -> Column:
    """Digits left-padded to 14; '' stays '', longer values are not cut."""
    d = digits_only(c)
    return F.when(F.length(d).between(1, ID_LENGTH - 1), F.lpad(d, ID_LENGTH, "0")).otherwise(d)


def format_id(c: Column | str) -> Column:
    """14 digits as XX.XXX.XXX/XXXX-XX, anything else unchanged."""
    c = _col(c)
    d = digits_only(c)
    shown = F.regexp_replace(
        d, r"^(\d{2})(\d{3})(\d{3})(\d{4})(\d{2})$", r"$1.$2.$3/$4-$5"
    )
    return F.when(F.length(d) == ID_LENGTH, shown).otherwise(c)


def registration_key(c: Column | str) -> Column:
    """Registrations are numbers written as text: leading zeros do not count."""
    return F.regexp_replace(F.trim(_col(c).cast("string")), "^0+(?=.)", "")


def id_number(c: Column | str) -> Column:
    """A 14-digit id as a number, NULL for anything else."""
    return matched(c, "^[0-9]{14}$").cast("bigint")


def digit(number: Column, place: int, width: int = ID_LENGTH) -> Column:
    """Digit at a 1-based place of a number of ``width`` digits."""
    shifted = F.call_function("div", number, F.lit(10 ** (width - place)).cast("bigint"))
    return shifted % 10


def check_digit(number: Column, weights: tuple[int, ...], width: int = ID_LENGTH) -> Column:
    """The modulus-11 digit of the leading digits: 11 - rest, or 0 for a rest below 2."""
    total = F.lit(0)
    for place, weight in enumerate(weights, start=1):
        total = total + digit(number, place, width) * weight
    return total * 10 % 11 % 10


def check_digits_agree(number: Column | str) -> Column:
    """Modulus-11 check of an id number; false for NULL, zero or one digit repeated.

    The number is used once per digit: give it as a column of an earlier
    projection, so that the text is parsed once.
    """
    number = _col(number)
    return F.coalesce(
        (number % 11_111_111_111_111 != 0)
        & (digit(number, 13) == check_digit(number, FIRST_WEIGHTS))
        & (digit(number, 14) == check_digit(number, SECOND_WEIGHTS)),
        F.lit(False),
    )


def has_valid_check_digits(c: Column | str) -> Column:
    """The same for id text, as one expression."""
    return check_digits_agree(id_number(c))


def invalid_reason(well_formed: Column, digits_ok: Column) -> Column:
    """'' for a valid id, else the first check that failed."""
    return (
        F.when(well_formed & digits_ok, F.lit(""))
        .when(~well_formed, F.lit(S.REASON_FORMAT))
        .otherwise(F.lit(S.REASON_CHECK_DIGITS))
    )


def format_problem(c: Column | str) -> Column:
    """Text of the format problem of a cleaned id, '' if there is none."""
    c = _col(c)
    size = F.length(c)
    return (
        F.when(c.isNull() | (c == ""), F.lit(EMPTY_TEXT))
        .when(size != ID_LENGTH, F.concat(F.lit(LENGTH_TEXT), size.cast("string")))
        .when(c == ZERO_ID, F.lit(ZERO_TEXT))
        .otherwise(F.lit(""))
    )
