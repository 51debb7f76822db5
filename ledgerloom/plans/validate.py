"""Validity columns, quality reports, quarantine and the consolidation report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom import schema as S
from ledgerloom.functions import periods
from ledgerloom.operators import quality, stats
from ledgerloom.sinks import tables


def validate(expense: DataFrame) -> DataFrame:
    """All validity columns; a projection, so it runs inside the scan stage."""
    checked = quality.id_validity(S.require_columns(expense, S.EXPENSE_COLUMNS, "expense"))
    return quality.period_validity(quality.name_validity(quality.amount_validity(checked)))


def quality_report(validated: DataFrame) -> DataFrame:
    """(check, n, pct): valid and invalid counts of every column, and the reasons."""
    reason = F.col("id_invalid_reason")
    checks = {
        "id_valid": F.col("id_valid"),
        "id_invalid": ~F.col("id_valid"),
        f"id_{S.REASON_FORMAT}": reason == S.REASON_FORMAT,
        f"id_{S.REASON_CHECK_DIGITS}": reason == S.REASON_CHECK_DIGITS,
        "amount_valid": F.col("amount_valid"),
        "amount_null": F.col("amount_null"),
        "amount_negative": F.col("amount_negative"),
        "amount_zero": F.col("amount_zero"),
        "name_valid": F.col("name_valid"),
        "name_empty": F.col("name_empty"),
        "name_short": F.col("name_short"),
        "quarter_invalid": ~F.col("quarter_valid"),
        "year_invalid": ~F.col("year_valid"),
    }
    return quality.count_checks(validated, checks)


def quarantine_report(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(quarantined rows, histogram of their flags)."""
    return tables.quarantine(flagged), quality.flag_histogram(flagged)


def consolidation_report(flagged: DataFrame) -> dict[str, DataFrame]:
    """What was consolidated: totals, rows per period, period labels, flags.

    Each part is a pass of its own: pass the written table, not the plan that
    flags it.
    """
    summary = stats.describe(
        flagged,
        "amount",
        [
            F.count_distinct("entity_id").alias("n_entities"),
            F.count_if(F.col("issue_flags") != "").alias("n_flagged"),
        ],
    ).drop("std")
    by_period = stats.row_counts_by_period(flagged)
    labels = by_period.select(periods.label("year", "quarter").alias("period")).orderBy(
        F.desc("period")
    )
    return {
        "summary": summary,
        "by_period": by_period,
        "periods": labels,
        "flags": quality.flag_histogram(flagged),
    }
