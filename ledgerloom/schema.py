"""Column contracts, header aliases and the fixed labels of the data model."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

# --- standard columns ------------------------------------------------------

EXPENSE_COLUMNS = ("entity_id", "entity_name", "quarter", "year", "amount")
REGISTRY_COLUMNS = ("entity_id", "registration", "entity_name", "category", "region")
AGGREGATED_COLUMNS = (
    "rank",
    "entity_name",
    "region",
    "total",
    "mean",
    "mean_per_quarter",
    "std",
    "cv_pct",
    "n_quarters",
    "high_variability",
)

EXPENSE = T.StructType(
    [
        T.StructField("entity_id", T.StringType(), False),
        T.StructField("entity_name", T.StringType(), False),
        T.StructField("quarter", T.ShortType(), False),
        T.StructField("year", T.ShortType(), False),
        T.StructField("amount", MONEY, True),
        T.StructField("issue_flags", T.StringType(), True),
        T.StructField("imported_at", T.TimestampType(), True),
    ]
)

REGISTRY = T.StructType(
    [
        T.StructField("entity_id", T.StringType(), False),
        T.StructField("registration", T.StringType(), True),
        T.StructField("entity_name", T.StringType(), True),
        T.StructField("category", T.StringType(), True),
        T.StructField("region", T.StringType(), True),
        T.StructField("registered_on", T.DateType(), True),
        T.StructField("imported_at", T.TimestampType(), True),
    ]
)

AGGREGATED = T.StructType(
    [
        T.StructField("entity_name", T.StringType(), False),
        T.StructField("region", T.StringType(), False),
        T.StructField("rank", T.IntegerType(), True),
        T.StructField("total", MONEY, True),
        T.StructField("mean", MONEY, True),
        T.StructField("mean_per_quarter", MONEY, True),
        T.StructField("std", MONEY, True),
        T.StructField("cv_pct", T.DecimalType(10, 2), True),
        T.StructField("n_quarters", T.IntegerType(), True),
        T.StructField("high_variability", T.BooleanType(), True),
        T.StructField("imported_at", T.TimestampType(), True),
    ]
)

# --- fixed values: column names of the exchanged files -----------------------

EXPENSE_STAGING = (
    "cnpj",
    "razao_social",
    "trimestre",
    "ano",
    "valor_despesas",
    "inconsistencia_flag",
)
AGGREGATED_STAGING = (
    "ranking",
    "razao_social",
    "uf",
    "total_despesas",
    "media_despesas",
    "media_por_trimestre",
    "desvio_padrao",
    "coeficiente_variacao",
    "numero_trimestres",
    "alta_variabilidade",
)
REGISTRY_STAGING = (
    "registro_ans",
    "cnpj",
    "razao_social",
    "nome_fantasia",
    "modalidade",
    "logradouro",
    "numero",
    "complemento",
    "bairro",
    "cidade",
    "uf",
    "cep",
    "ddd",
    "telefone",
    "fax",
    "email",
    "representante",
    "cargo_representante",
    "regiao_de_comercializacao",
    "data_registro_ans",
)

# Accepted headers of expense files, per standard column.
EXPENSE_ALIASES: Mapping[str, tuple[str, ...]] = {
    "entity_id": ("cnpj", "cnpj_operadora", "cd_cnpj", "num_cnpj"),
    "entity_name": ("razao_social", "razaosocial", "nm_razao_social", "nome", "operadora"),
    "quarter": ("trimestre", "tri", "cd_trimestre", "num_trimestre"),
    "year": ("ano", "ano_competencia", "cd_ano"),
    "amount": (
        "valor",
        "valor_despesa",
        "valor_despesas",
        "vl_despesa",
        "despesa",
        "despesas",
        "eventos",
        "sinistros",
    ),
}

# Accepted headers of registry files.
REGISTRY_ALIASES: Mapping[str, tuple[str, ...]] = {
    "entity_id": ("cnpj", "cd_cnpj"),
    "registration": (
        "registro_ans",
        "cd_registro_ans",
        "registro_operadora",
        "registro_operadora_ans",
    ),
    "entity_name": ("razao_social", "nm_razao_social"),
    "category": ("modalidade", "ds_modalidade", "sg_modalidade"),
    "region": ("uf", "sg_uf"),
}

# Accepted headers of raw accounting (ledger) files.
LEDGER_ALIASES: Mapping[str, tuple[str, ...]] = {
    "registration": ("reg_ans", "registro_ans"),
    "description": ("descricao",),
    "amount": ("vl_saldo_final",),
}

# Words that select the expense lines of a ledger, and relevant file names.
LEDGER_WORDS = ("evento", "sinistro")
FILE_WORDS = ("despesa", "evento", "sinistro")
REGISTRY_FILES = r"(?i)^Relatorio_cadop.*\.csv$"

# --- fixed values: labels ------------------------------------------------------

UNKNOWN = "NÃO_INFORMADO"
MATCHED = "MATCH_CADASTRO"
UNMATCHED = "SEM_CADASTRO"
REGISTRY_ONLY = "APENAS_CADASTRO"
MATCH_LABELS = (MATCHED, UNMATCHED, REGISTRY_ONLY)

FLAG_BLANK_NAME = "RAZAO_VAZIA"
FLAG_BLANK_ID = "CNPJ_SEM_MATCH"
FLAG_BAD_ID = "CNPJ_INVALIDO"
FLAG_NULL_AMOUNT = "VALOR_NULO"
FLAG_NEGATIVE_AMOUNT = "VALOR_NEGATIVO"
FLAG_ZERO_AMOUNT = "VALOR_ZERADO"
FLAG_BAD_QUARTER = "TRIMESTRE_INVALIDO"
FLAG_BAD_YEAR = "ANO_INVALIDO"
FLAG_DIVERGENT_NAME = "CNPJ_RAZAO_DIVERGENTE"

REASON_FORMAT = "FORMATO_INVALIDO"
REASON_CHECK_DIGITS = "DIGITOS_VERIFICADORES_INVALIDOS"

FIRST_YEAR, LAST_YEAR = 2000, 2030


# --- serving headers -----------------------------------------------------------

# Headers that the serving layer accepts, per column.
SERVING_ALIASES: Mapping[str, tuple[str, ...]] = {
    "entity_id": ("cnpj",),
    "entity_name": ("razao_social", "razaosocial"),
    "registration": ("registro_ans", "registroans", "registro_operadora", "registro_operadora_ans"),
    "category": ("modalidade",),
    "region": ("uf",),
    "quarter": ("trimestre",),
    "year": ("ano",),
    "amount": ("valor_despesas", "valordespesas"),
    "issue_flags": ("inconsistencia_flag",),
    "total": ("total_despesas", "totaldespesas"),
    "mean": ("media_despesas", "mediadespesas"),
    "mean_per_quarter": ("media_por_trimestre", "mediaportrimestre"),
    "std": ("desvio_padrao", "desviopadrao"),
    "cv_pct": ("coeficiente_variacao", "coeficientevariacao"),
    "n_quarters": ("numero_trimestres", "numerotrimestres"),
    "high_variability": ("alta_variabilidade", "altavariabilidade"),
    "rank": ("ranking",),
}

# Where a registry row stands in the files it was read from.
FILE_ORDER = ("src_file", "line_at")


def registry_order(registry: DataFrame) -> tuple[str, ...]:
    """What "first" means in a registry: file order where it is known, else a total order."""
    if set(FILE_ORDER) <= set(registry.columns):
        return FILE_ORDER
    order = ("registration", "entity_id", "entity_name", "category", "region")
    return tuple(c for c in order if c in registry.columns)


def all_string(columns: Iterable[str]) -> T.StructType:
    """Read contract of staging files: every column is text, nothing inferred."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def require_columns(df: DataFrame, required: Iterable[str], what: str = "input") -> DataFrame:
    """Fail while the plan is being built when a mandatory column is absent."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks the columns {missing}; it has {df.columns}")
    return df


def export_projection(
    df: DataFrame, required: Iterable[str], optional: Iterable[str] = ()
) -> DataFrame:
    """Mandatory columns checked, optional ones filled with '' when absent."""
    required, optional = list(required), list(optional)
    require_columns(df, required, "export")
    extra = [F.col(c) if c in df.columns else F.lit("").alias(c) for c in optional]
    return df.select(*required, *extra)


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Project onto a typed contract; absent columns become NULL."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in contract.fields
        ]
    )
