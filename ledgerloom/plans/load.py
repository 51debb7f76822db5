"""All-text staging tables to typed tables, with the rejected rows kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom import schema as S
from ledgerloom.functions import ids, numbers, periods, text
from ledgerloom.operators import filters
from ledgerloom.session import materialize


def typed_expense(staging: DataFrame) -> DataFrame:
    """Staged expense text, parsed; nothing is filtered yet."""
    S.require_columns(staging, S.EXPENSE_STAGING, "expense staging")
    t = {c: text.blank_to_null(c) for c in S.EXPENSE_STAGING if c != "cnpj"}
    return staging.select(
        ids.digits_only("cnpj").alias("entity_id"),
        t["razao_social"].alias("entity_name"),
        numbers.whole_number(t["trimestre"]).alias("quarter"),
        numbers.whole_number(t["ano"]).alias("year"),
        numbers.mixed_decimal(t["valor_despesas"]).alias("amount"),
        t["inconsistencia_flag"].alias("issue_flags"),
    )


def load_expense(staging: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) typed rows; every staged row is in one of them.

    The text is parsed once and stored typed; both results read that table.
    """
    judged = typed_expense(staging).withColumn("_accepted", filters.loadable())
    accepted, rejected = filters.split_by(materialize(judged, "typed"), F.col("_accepted"))
    return accepted.drop("_accepted"), rejected.drop("_accepted")


def load_registry(staging: DataFrame) -> DataFrame:
    """Registry rows with a 14-digit id."""
    S.require_columns(staging, S.REGISTRY_STAGING, "registry staging")
    typed = staging.select(
        ids.digits_only("cnpj").alias("entity_id"),
        text.blank_to_null("registro_ans").alias("registration"),
        text.blank_to_null("razao_social").alias("entity_name"),
        text.blank_to_null("modalidade").alias("category"),
        text.blank_to_null("uf").alias("region"),
        periods.parse_date("data_registro_ans").alias("registered_on"),
    )
    return filters.full_length_ids(typed)


def load_aggregated(staging: DataFrame) -> DataFrame:
    """Aggregated rows whose name and region are known."""
    S.require_columns(staging, S.AGGREGATED_STAGING, "aggregated staging")
    t = {c: text.blank_to_null(c) for c in S.AGGREGATED_STAGING}
    typed = staging.select(
        t["razao_social"].alias("entity_name"),
        t["uf"].alias("region"),
        numbers.whole_number(t["ranking"], "int").alias("rank"),
        numbers.plain_decimal(t["total_despesas"]).alias("total"),
        numbers.plain_decimal(t["media_despesas"]).alias("mean"),
        numbers.plain_decimal(t["media_por_trimestre"]).alias("mean_per_quarter"),
        numbers.plain_decimal(t["desvio_padrao"]).alias("std"),
        numbers.plain_decimal(t["coeficiente_variacao"], 10).alias("cv_pct"),
        numbers.whole_number(t["numero_trimestres"], "int").alias("n_quarters"),
        text.parse_boolean(t["alta_variabilidade"]).alias("high_variability"),
    )
    return typed.dropna(subset=["entity_name", "region"])


def stage_aggregated(aggregated: DataFrame) -> DataFrame:
    """The aggregated table as the text that is exchanged."""
    names = dict(zip(S.AGGREGATED_COLUMNS, S.AGGREGATED_STAGING))
    money = [c for c in S.AGGREGATED_COLUMNS if c in ("total", "mean", "mean_per_quarter", "std", "cv_pct")]
    rounded = aggregated.withColumns({c: F.col(c).cast(S.MONEY) for c in money})
    return rounded.select(*[F.col(c).cast("string").alias(n) for c, n in names.items()])
