"""Views over the given tables, once for Spark and once as SQL for the oracle.

The modulo rules plant dirty values (blank ids, missing names, impossible
quarters, NULL, zero and negative amounts); no row is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _padded(key: str) -> Column:
    return F.lpad(F.col(key).cast("string"), 14, "0")


def _every(key: str, n: int) -> Column:
    return F.col(key) % n == 0


# --- E: expenses ---------------------------------------------------------------------


def expense(spark: SparkSession, folder: str) -> DataFrame:
    orders, customer = table(spark, folder, "orders"), table(spark, folder, "customer")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    k, price = "o_orderkey", F.col("o_totalprice").cast(MONEY)
    return joined.select(
        F.col(k).alias("line_no"),
        F.col("o_orderstatus").alias("src_file"),
        F.when(_every(k, 97), F.lit("")).otherwise(_padded("o_custkey")).alias("entity_id"),
        F.when(_every(k, 89), F.lit(None))
        .when(_every(k, 53), F.concat("c_name", F.lit(" SA")))
        .otherwise(F.col("c_name"))
        .alias("entity_name"),
        F.when(~_every(k, 103), F.year("o_orderdate")).cast("smallint").alias("year"),
        F.when(_every(k, 101), F.lit(5))
        .otherwise(F.quarter("o_orderdate"))
        .cast("smallint")
        .alias("quarter"),
        F.when(_every(k, 43), F.lit(None))
        .when(_every(k, 41), F.lit(0).cast(MONEY))
        .when(_every(k, 37), (-price).cast(MONEY))
        .otherwise(price)
        .alias("amount"),
    )


E = """
e AS (
  SELECT o_orderkey AS line_no, o_orderstatus AS src_file,
    CASE WHEN o_orderkey % 97 = 0 THEN ''
         ELSE lpad(CAST(o_custkey AS VARCHAR), 14, '0') END AS entity_id,
    CASE WHEN o_orderkey % 89 = 0 THEN NULL
         WHEN o_orderkey % 53 = 0 THEN c_name || ' SA' ELSE c_name END AS entity_name,
    CASE WHEN o_orderkey % 103 = 0 THEN NULL
         ELSE CAST(year(o_orderdate) AS INTEGER) END AS year,
    CASE WHEN o_orderkey % 101 = 0 THEN 5
         ELSE CAST(quarter(o_orderdate) AS INTEGER) END AS quarter,
    CASE WHEN o_orderkey % 43 = 0 THEN NULL
         WHEN o_orderkey % 41 = 0 THEN CAST(0 AS DECIMAL(18,2))
         WHEN o_orderkey % 37 = 0 THEN -CAST(o_totalprice AS DECIMAL(18,2))
         ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS amount
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""


def unlinked_expense(spark: SparkSession, folder: str) -> DataFrame:
    """E in which ids ending in 7 are lost, so that only the name is left."""
    lost = F.col("entity_id").endswith("7")
    linked = F.when(lost, F.lit("")).otherwise(F.col("entity_id"))
    return expense(spark, folder).withColumn("entity_id", linked)


U = (
    E
    + """,
u AS (
  SELECT line_no, src_file, CASE WHEN entity_id LIKE '%7' THEN '' ELSE entity_id END AS entity_id,
    entity_name, year, quarter, amount
  FROM e
)"""
)

# --- R: registry ---------------------------------------------------------------------


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    customer, nation = table(spark, folder, "customer"), table(spark, folder, "nation")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))


def _registry_columns(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("c_custkey").cast("string").alias("registration"),
        _padded("c_custkey").alias("entity_id"),
        F.col("c_name").alias("entity_name"),
        F.col("c_mktsegment").alias("category"),
        F.when(~_every("c_custkey", 29), F.col("n_name")).alias("region"),
    )


def registry(spark: SparkSession, folder: str) -> DataFrame:
    return _registry_columns(_customers(spark, folder).filter(F.col("c_custkey") % 10 != 3))


def missing_registry(spark: SparkSession, folder: str) -> DataFrame:
    """The customers the registry does not have."""
    return _registry_columns(_customers(spark, folder).filter(F.col("c_custkey") % 10 == 3))


_R_COLUMNS = """
  SELECT CAST(c_custkey AS VARCHAR) AS registration,
    lpad(CAST(c_custkey AS VARCHAR), 14, '0') AS entity_id,
    c_name AS entity_name, c_mktsegment AS category,
    CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE n_name END AS region
  FROM customer JOIN nation ON c_nationkey = n_nationkey"""

R = f"""
r AS ({_R_COLUMNS}
  WHERE c_custkey % 10 <> 3
)"""
R_MISSING = f"""
rm AS ({_R_COLUMNS}
  WHERE c_custkey % 10 = 3
)"""


def gapped_registry(spark: SparkSession, folder: str) -> DataFrame:
    """R without the name of every entity whose id ends in 1."""
    gap = F.col("entity_id").endswith("1")
    name = F.when(~gap, F.col("entity_name"))
    return registry(spark, folder).withColumn("entity_name", name)


R_GAPS = (
    R
    + """,
rg AS (
  SELECT entity_id, registration,
    CASE WHEN entity_id LIKE '%1' THEN NULL ELSE entity_name END AS entity_name, category, region
  FROM r
)"""
)

# --- G: ledger text --------------------------------------------------------------------


def ledger(spark: SparkSession, folder: str) -> DataFrame:
    line, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    part = table(spark, folder, "part")
    joined = line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        part, F.col("l_partkey") == F.col("p_partkey")
    )
    price = F.col("l_extendedprice").cast(MONEY).cast("string")
    words = F.replace(F.upper("p_name"), F.lit("RING"), F.lit("EVENTO"))
    return joined.select(
        F.lpad(F.col("o_custkey").cast("string"), 6, "0").alias("registration"),
        F.replace(words, F.lit("BOLT"), F.lit("SINISTRO")).alias("description"),
        F.translate(price, ".", ",").alias("amount"),
        F.year("o_orderdate").alias("year"),
        F.quarter("o_orderdate").alias("quarter"),
    )


G = """
g AS (
  SELECT lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS registration,
    replace(replace(upper(p_name), 'RING', 'EVENTO'), 'BOLT', 'SINISTRO') AS description,
    replace(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',') AS amount,
    CAST(year(o_orderdate) AS INTEGER) AS year, CAST(quarter(o_orderdate) AS INTEGER) AS quarter
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
)"""

# Expense lines of the ledger with their registry entry, as text-free SQL.
G_LOOKED_UP = """
gl AS (
  SELECT r.entity_id, r.entity_name, g.year, g.quarter,
    CAST(replace(g.amount, ',', '.') AS DECIMAL(18,2)) AS amount
  FROM g LEFT JOIN r ON r.registration = CAST(CAST(g.registration AS BIGINT) AS VARCHAR)
  WHERE lower(g.description) LIKE '%evento%' OR lower(g.description) LIKE '%sinistro%'
)"""

# --- S: staging text -------------------------------------------------------------------


def staging(spark: SparkSession, folder: str) -> DataFrame:
    orders, customer = table(spark, folder, "orders"), table(spark, folder, "customer")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    k = "o_orderkey"
    price = F.col("o_totalprice").cast(MONEY).cast("string")
    return joined.select(
        F.col(k).alias("line_no"),
        F.when(_every(k, 97), F.lit("x"))
        .when(_every(k, 3), F.concat(F.lit("  "), _padded("o_custkey")))
        .otherwise(_padded("o_custkey"))
        .alias("cnpj"),
        F.when(_every(k, 89), F.lit("  ")).otherwise(F.col("c_name")).alias("razao_social"),
        F.when(_every(k, 101), F.lit("T1"))
        .otherwise(F.quarter("o_orderdate").cast("string"))
        .alias("trimestre"),
        F.year("o_orderdate").cast("string").alias("ano"),
        F.when(_every(k, 43), F.lit(""))
        .when(_every(k, 47), F.lit("1e5"))
        .when(_every(k, 2), F.translate(price, ".", ","))
        .otherwise(price)
        .alias("valor_despesas"),
        F.lit("").alias("inconsistencia_flag"),
    )


S = """
s AS (
  SELECT o_orderkey AS line_no,
    CASE WHEN o_orderkey % 97 = 0 THEN 'x'
         WHEN o_orderkey % 3 = 0 THEN '  ' || lpad(CAST(o_custkey AS VARCHAR), 14, '0')
         ELSE lpad(CAST(o_custkey AS VARCHAR), 14, '0') END AS cnpj,
    CASE WHEN o_orderkey % 89 = 0 THEN '  ' ELSE c_name END AS razao_social,
    CASE WHEN o_orderkey % 101 = 0 THEN 'T1'
         ELSE CAST(quarter(o_orderdate) AS VARCHAR) END AS trimestre,
    CAST(year(o_orderdate) AS VARCHAR) AS ano,
    CASE WHEN o_orderkey % 43 = 0 THEN ''
         WHEN o_orderkey % 47 = 0 THEN '1e5'
         WHEN o_orderkey % 2 = 0
           THEN replace(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',')
         ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS valor_despesas,
    '' AS inconsistencia_flag
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""

# --- staged registry and aggregated text -------------------------------------------------


def registry_staging(spark: SparkSession, folder: str) -> DataFrame:
    """Twenty text columns; ids formatted, dates in several spellings."""
    from ledgerloom.functions import ids
    from ledgerloom.schema import REGISTRY_STAGING

    k = "c_custkey"
    day = F.lpad((F.col(k) % 28 + 1).cast("string"), 2, "0")
    values = {
        "registro_ans": F.concat(F.lit(" "), F.col(k).cast("string")),
        "cnpj": F.when(_every(k, 7), F.col(k).cast("string"))
        .when(_every(k, 2), ids.format_id(_padded(k)))
        .otherwise(_padded(k)),
        "razao_social": F.when(_every(k, 11), F.lit(" ")).otherwise(F.col("c_name")),
        "modalidade": F.col("c_mktsegment"),
        "uf": F.when(_every(k, 29), F.lit("")).otherwise(F.col("n_name")),
        "data_registro_ans": F.when(_every(k, 5), F.lit("x"))
        .when(_every(k, 4), F.concat(F.lit("31/02/20"), day))
        .when(_every(k, 3), F.concat(F.lit("2020-03-"), day))
        .otherwise(F.concat(day, F.lit("/03/2020"))),
    }
    return _customers(spark, folder).select(
        *[values.get(c, F.lit("")).alias(c) for c in REGISTRY_STAGING]
    )


SR = """
sr AS (
  SELECT ' ' || CAST(c_custkey AS VARCHAR) AS registro_ans,
    CASE WHEN c_custkey % 7 = 0 THEN CAST(c_custkey AS VARCHAR)
         ELSE lpad(CAST(c_custkey AS VARCHAR), 14, '0') END AS cnpj,
    CASE WHEN c_custkey % 11 = 0 THEN ' ' ELSE c_name END AS razao_social,
    c_mktsegment AS modalidade,
    CASE WHEN c_custkey % 29 = 0 THEN '' ELSE n_name END AS uf,
    CASE WHEN c_custkey % 5 = 0 THEN 'x'
         WHEN c_custkey % 4 = 0 THEN '31/02/20' || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0')
         WHEN c_custkey % 3 = 0 THEN '2020-03-' || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0')
         ELSE lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') || '/03/2020'
         END AS data_registro_ans
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""


def aggregated_staging(spark: SparkSession, folder: str) -> DataFrame:
    k = "c_custkey"
    balance = F.col("c_acctbal").cast(MONEY).cast("string")
    word = F.element_at(
        F.array(*[F.lit(w) for w in ("TRUE", "f", "1", "No", "y", "maybe")]),
        (F.col(k) % 6 + 1).cast("int"),
    )
    return _customers(spark, folder).select(
        F.col(k).cast("string").alias("ranking"),
        F.when(_every(k, 11), F.lit(" ")).otherwise(F.col("c_name")).alias("razao_social"),
        F.when(_every(k, 29), F.lit("")).otherwise(F.col("n_name")).alias("uf"),
        balance.alias("total_despesas"),
        F.when(_every(k, 4), F.lit("n/a")).otherwise(balance).alias("media_despesas"),
        F.concat(balance, F.lit("5")).alias("media_por_trimestre"),
        F.lit("1e5").alias("desvio_padrao"),
        F.when(_every(k, 2), F.lit("12.5")).otherwise(F.lit(".5")).alias("coeficiente_variacao"),
        F.when(_every(k, 3), F.lit("-1")).otherwise(F.lit(" 3 ")).alias("numero_trimestres"),
        word.alias("alta_variabilidade"),
    )


SA = """
sa AS (
  SELECT CAST(c_custkey AS VARCHAR) AS ranking,
    CASE WHEN c_custkey % 11 = 0 THEN ' ' ELSE c_name END AS razao_social,
    CASE WHEN c_custkey % 29 = 0 THEN '' ELSE n_name END AS uf,
    CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS total_despesas,
    CASE WHEN c_custkey % 4 = 0 THEN 'n/a'
         ELSE CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) END AS media_despesas,
    CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) || '5' AS media_por_trimestre,
    '1e5' AS desvio_padrao,
    CASE WHEN c_custkey % 2 = 0 THEN '12.5' ELSE '.5' END AS coeficiente_variacao,
    CASE WHEN c_custkey % 3 = 0 THEN '-1' ELSE ' 3 ' END AS numero_trimestres,
    ['TRUE','f','1','No','y','maybe'][c_custkey % 6 + 1] AS alta_variabilidade
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""

# --- generated identifiers ---------------------------------------------------------------


def check_digit_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Valid check digits for even customers, '00' for odd ones."""
    from ledgerloom.functions.ids import FIRST_WEIGHTS, SECOND_WEIGHTS, check_digit

    key = F.col("c_custkey")
    based = table(spark, folder, "customer").select(
        "c_custkey", ((F.lit(11222333) + key) * 10_000 + 1).alias("base")
    )
    once = based.withColumn(
        "one", F.col("base") * 10 + check_digit(F.col("base"), FIRST_WEIGHTS, 12)
    )
    twice = once.withColumn(
        "two", F.col("one") * 10 + check_digit(F.col("one"), SECOND_WEIGHTS, 13)
    )
    number = F.when(_every("c_custkey", 2), F.col("two")).otherwise(F.col("base") * 100)
    return twice.select("c_custkey", F.lpad(number.cast("string"), 14, "0").alias("entity_id"))


def _digit_sum(text: str, weights: tuple[int, ...]) -> str:
    return " + ".join(
        f"CAST(substr({text}, {i}, 1) AS INTEGER) * {w}" for i, w in enumerate(weights, start=1)
    )


def _digit_sql(text: str, weights: tuple[int, ...]) -> str:
    rest = f"(({_digit_sum(text, weights)}) % 11)"
    return f"CASE WHEN {rest} < 2 THEN 0 ELSE 11 - {rest} END"


_W1, _W2 = (5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2), (6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)

IDS = f"""
b AS (
  SELECT c_custkey, lpad(CAST(11222333 + c_custkey AS VARCHAR), 8, '0') || '0001' AS base
  FROM customer
),
b1 AS (SELECT c_custkey, base, base || CAST({_digit_sql("base", _W1)} AS VARCHAR) AS one FROM b),
ids AS (
  SELECT c_custkey, CASE WHEN c_custkey % 2 = 0
    THEN one || CAST({_digit_sql("one", _W2)} AS VARCHAR) ELSE base || '00' END AS entity_id
  FROM b1
),
checked AS (
  SELECT c_custkey, entity_id,
    {_digit_sql("entity_id", _W1)} AS d1, {_digit_sql("entity_id", _W2)} AS d2,
    CAST(substr(entity_id, 13, 1) AS INTEGER) AS s1, CAST(substr(entity_id, 14, 1) AS INTEGER) AS s2
  FROM ids
)"""
