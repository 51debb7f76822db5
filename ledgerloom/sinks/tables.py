"""Delimited output and Parquet tables: append, reload, upsert, quarantine."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import schema as S
from ledgerloom.operators import columns as C
from ledgerloom.operators import joins, quality
from ledgerloom.session import materialize, replace_folder, scratch

PERIOD = ("year", "quarter")


def write_delimited(
    df: DataFrame, path: str, columns: Iterable[str] | None = None, compression: str | None = None
) -> None:
    """';'-separated UTF-8 text with a header; ``compression='gzip'`` to deflate it.

    Quotes inside a field are doubled.
    """
    out = df.select(*columns) if columns else df
    writer = out.write.mode("overwrite").option("sep", ";").option("header", True)
    writer = writer.option("escape", '"')
    # empty text stays empty between the separators, as NULL does; blanks are kept
    writer = writer.option("emptyValue", "").option("nullValue", "")
    writer = writer.option("ignoreLeadingWhiteSpace", False)
    writer = writer.option("ignoreTrailingWhiteSpace", False)
    if compression:
        writer = writer.option("compression", compression)
    writer.csv(path)


def two_decimals(df: DataFrame) -> DataFrame:
    """Floating-point columns as decimals with two places, for output."""
    return df.withColumns(
        {
            f.name: F.col(f.name).cast(S.MONEY)
            for f in df.schema.fields
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
        }
    )


def quarantine(df: DataFrame, flags: str = "issue_flags") -> DataFrame:
    """The flagged rows, standard columns and flags only."""
    return df.filter(F.col(flags) != "").select(*S.EXPENSE_COLUMNS, flags)


def write_quarantine(df: DataFrame, path: str, flags: str = "issue_flags") -> bool:
    """Write the flagged rows; nothing is written when there are none."""
    flagged = quarantine(df, flags)
    if flagged.isEmpty():
        return False
    write_delimited(flagged, path)
    return True


def stamp(df: DataFrame) -> DataFrame:
    """Add the import time."""
    return C.add_if_absent(df, {"imported_at": F.current_timestamp()})


def append(df: DataFrame, path: str, partition_by: Iterable[str] = PERIOD) -> None:
    """Append rows; running it twice doubles them."""
    _by_period(df, partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)


def load_periods(df: DataFrame, path: str, partition_by: Iterable[str] = PERIOD) -> None:
    """Replace exactly the periods present in ``df``; running it twice changes nothing."""
    (
        _by_period(df, partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def _by_period(df: DataFrame, partition_by: Iterable[str]) -> DataFrame:
    """Few files per period; a period too large for one task is split at run time."""
    return df.hint("rebalance", *partition_by)


def reload(df: DataFrame, path: str) -> None:
    """Truncate and load."""
    df.write.mode("overwrite").parquet(path)


def upsert(target: DataFrame, batch: DataFrame, keys: Iterable[str], check: bool = True) -> DataFrame:
    """Rows of the batch replace those with the same key, others are added.

    A batch that repeats a key is an error: which row should win is undefined.
    """
    keys = list(keys)
    if check:
        quality.require_unique(batch, keys)
    replaced = joins.sized_side(batch.select(*keys), "replaced")  # stored: the planner knows its size
    kept = target.join(replaced, keys, "left_anti")
    return kept.unionByName(batch.select(*target.columns))


def upsert_table(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Iterable[str],
    partition_by: Iterable[str] = (),
) -> None:
    """Upsert into a Parquet table, which is never without a whole state.

    The new state is written beside the table.  Without partitions it then changes places
    with the table, and the old one goes only after that.  With ``partition_by``, which
    must be among the keys, only the partitions that the batch touches are read and
    replaced, each in one step of Spark's committer; the copy stays if that fails.
    """
    keys, partition_by = list(keys), list(partition_by)
    table = spark.read.parquet(path)
    if not partition_by:
        beside = f"{path.rstrip('/')}__next_{uuid.uuid4().hex}"
        upsert(table, batch, keys).write.parquet(beside)
        replace_folder(spark, beside, path)
        return
    if not set(partition_by) <= set(keys):
        raise ValueError("partition columns must be among the keys: a row must not change its partition")
    with scratch(spark):
        touched = joins.sized_side(batch.select(*partition_by).distinct(), "touched")
        affected = table.join(touched, partition_by, "left_semi")
        merged = materialize(upsert(affected, batch, keys), "upsert")
        load_periods(merged, path, partition_by)


def read_evolved(spark: SparkSession, path: str, contract: T.StructType) -> DataFrame:
    """Read files of several schema generations; added columns are NULL in old ones."""
    return S.conform(spark.read.option("mergeSchema", True).parquet(path), contract)


# --- tables that know their layout ------------------------------------------------------------


def stored_periods(spark: SparkSession, path: str) -> DataFrame:
    """The (year, quarter) pairs of a table loaded by period, from its folder names alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    named = files.load(path).select(
        *[F.regexp_extract("path", f"/{c}=([0-9]+)/", 1).alias(c) for c in PERIOD]
    )
    known = named.filter("year <> '' and quarter <> ''").distinct()
    return known.select(*[F.col(c).cast("int").alias(c) for c in PERIOD])


def of_periods(periods: Iterable[tuple[int | None, int | None]]) -> Column:
    """A condition on the partition columns alone, which Spark applies to its file list."""
    chosen = F.lit(False)
    for year, quarter in periods:
        chosen = chosen | (F.col("year").eqNullSafe(F.lit(year)) & F.col("quarter").eqNullSafe(F.lit(quarter)))
    return chosen


def read_latest_periods(spark: SparkSession, path: str, n: int = 3) -> DataFrame:
    """The rows of the n newest periods; other periods' files are not opened, not even to find them."""
    newest = stored_periods(spark, path).orderBy(F.desc("year"), F.desc("quarter")).limit(n).collect()
    return spark.read.parquet(path).filter(of_periods([(r.year, r.quarter) for r in newest]))


def load_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> None:
    """Replace a catalog table bucketed and sorted by ``key``, one file a bucket.

    Tables with the same number of buckets are joined, and grouped, by the key without an exchange.  Rows
    with a blank key, which match nothing and may be many, belong elsewhere: see ``with_key``.
    """
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    writer.option("path", path).saveAsTable(name)


def with_key(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows with a key, and those without."""
    blank = F.col(key).isNull() | (F.col(key) == "")
    return df.filter(~blank), df.filter(blank)
