"""The library's expressions as functions of Spark SQL.

``register`` creates temporary functions whose bodies are SQL, so the planner inlines them: no Python and no call is
left in a plan.  They give what the Column functions of the same names give.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.functions import ids, numbers

HISTORY_VIEW = "ledgerloom_summary"


def _quoted(pattern: str) -> str:
    return "r'" + pattern + "'"


def _digit(place: int) -> str:
    return f"(n div {10 ** (ids.ID_LENGTH - place)}L % 10)"


def _check_digit(weights: tuple[int, ...]) -> str:
    total = " + ".join(f"{_digit(place)} * {weight}" for place, weight in enumerate(weights, start=1))
    return f"({total}) * 10 % 11 % 10"


def _decimal(number: str, pattern: str, group: int) -> str:
    return f"try_cast(nullif(regexp_extract({number}, {_quoted(pattern)}, {group}), '') AS DECIMAL(18,2))"


def _functions() -> dict[str, tuple[str, str]]:
    """Signature -> (type, body); later bodies use earlier functions."""
    swapped = "translate(c, ',.', '.')"
    repeated = "1" * ids.ID_LENGTH
    return {
        "digits_only(c STRING)": ("STRING", "coalesce(regexp_replace(c, '[^0-9]', ''), '')"),
        "padded_id(c STRING)": (
            "STRING",
            f"CASE WHEN length(digits_only(c)) BETWEEN 1 AND {ids.ID_LENGTH - 1} "
            f"THEN lpad(digits_only(c), {ids.ID_LENGTH}, '0') ELSE digits_only(c) END",
        ),
        "format_id(c STRING)": (
            "STRING",
            f"CASE WHEN length(digits_only(c)) = {ids.ID_LENGTH} THEN regexp_replace(digits_only(c), "
            r"r'^(\d{2})(\d{3})(\d{3})(\d{4})(\d{2})$', r'$1.$2.$3/$4-$5') ELSE c END",
        ),
        "id_number(c STRING)": ("BIGINT", f"CAST(nullif(regexp_extract(c, '^[0-9]{{{ids.ID_LENGTH}}}$', 0), '') AS BIGINT)"),
        "check_digits_agree(n BIGINT)": (
            "BOOLEAN",
            f"coalesce(n % {repeated}L <> 0 AND {_digit(13)} = {_check_digit(ids.FIRST_WEIGHTS)} "
            f"AND {_digit(14)} = {_check_digit(ids.SECOND_WEIGHTS)}, FALSE)",
        ),
        "has_valid_check_digits(c STRING)": ("BOOLEAN", "check_digits_agree(id_number(c))"),
        "normal_name(c STRING)": (
            "STRING",
            r"coalesce(upper(regexp_replace(regexp_replace(c, r'^\s+|\s+$', ''), ' {2,}', ' ')), '')",
        ),
        "comma_decimal(c STRING)": ("DECIMAL(18,2)", _decimal(swapped, numbers.ANY_NUMBER, 1)),
        "mixed_decimal(c STRING)": (
            "DECIMAL(18,2)",
            _decimal(f"CASE WHEN contains(c, ',') THEN {swapped} ELSE c END", numbers.PLAIN_DECIMAL, 0),
        ),
        "growth_pct(a DECIMAL(38,2), b DECIMAL(38,2))": ("DOUBLE", "round(try_divide((b - a) * 100, a), 2)"),
    }


# The quarter totals of one entity by its id in any form; a series without a positive total is left out.
_HISTORY = f"""
CREATE OR REPLACE TEMPORARY FUNCTION entity_history(id STRING)
RETURNS TABLE(year INT, quarter INT, total DECIMAL(38,2))
RETURN SELECT year, quarter, total FROM (
  SELECT CAST(year AS INT) AS year, CAST(quarter AS INT) AS quarter,
    CAST(coalesce(sum(total), 0) AS DECIMAL(38,2)) AS total, max(coalesce(sum(total), 0)) OVER () AS best
  FROM {HISTORY_VIEW}
  WHERE entity_id = padded_id(id) AND entity_id <> '' AND year IS NOT NULL AND quarter IS NOT NULL
  GROUP BY year, quarter
) WHERE best > 0
"""


def register(spark: SparkSession, summary: DataFrame | None = None) -> list[str]:
    """Create the functions in a session and return their names.

    With a ``summary`` (``serving.summarize``) there is also the table function ``entity_history(id)``.
    """
    made = []
    for signature, (kind, body) in _functions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {kind} RETURN {body}")
        made.append(signature.split("(")[0])
    if summary is not None:
        summary.createOrReplaceTempView(HISTORY_VIEW)
        spark.sql(_HISTORY)
        made.append("entity_history")
    return made
