"""Choosing files: format, relevance, periods, snapshots."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import schema as S
from ledgerloom.functions import periods, text

# Suffixes by kind of file.
TEXT_FILES = "*.{[cC][sS][vV],[tT][xX][tT]}"
FORMATS = {"csv": (".csv", ".txt"), "archive": (".zip",), "excel": (".xlsx", ".xls")}


def file_name(path: Column | str) -> Column:
    """Last path segment, without query or fragment."""
    path = F.col(path) if isinstance(path, str) else path
    return F.regexp_extract(path, r"([^/?#]*)(?:[?#].*)?$", 1)


def suffix(name: Column | str) -> Column:
    name = F.col(name) if isinstance(name, str) else name
    return F.lower(F.regexp_extract(name, r"\.[^.]+$", 0))


def format_of(name: Column | str) -> Column:
    """'csv', 'archive', 'excel' or NULL for anything else."""
    kind = F.lit(None).cast("string")
    for label, endings in FORMATS.items():
        kind = F.when(suffix(name).isin(*endings), F.lit(label)).otherwise(kind)
    return kind


def is_relevant(
    name: Column | str, year: Column, quarter: Column, words: tuple[str, ...] = S.FILE_WORDS
) -> Column:
    """One of the words occurs, or the name is the archive of its period."""
    name = F.col(name) if isinstance(name, str) else name
    archive = F.concat(quarter.cast("string"), F.lit("t"), year.cast("string"), F.lit(".zip"))
    return text.contains_any(name, words) | F.coalesce(
        F.contains(F.lower(name), archive), F.lit(False)
    )


def listed_links(listing: Column | str) -> Column:
    """The targets of all links in the text of a directory listing."""
    return F.regexp_extract_all(listing, F.lit(r'href="([^"]*)"'), F.lit(1))


def is_chosen(path: Column | str, chosen: Iterable[tuple[int, int]]) -> Column:
    """A relevant file of one of the given (year, quarter) periods."""
    year, quarter = periods.period_in_name(path)
    # readers evaluate this for every line, too: the period is looked for once, not once for each choice
    of_period = (year * 10 + quarter).isin([y * 10 + q for y, q in chosen])
    return F.coalesce(of_period, F.lit(False)) & is_relevant(_shown(path), year, quarter)


def _shown(path: Column | str) -> Column:
    """Folder and file name: of a data set Spark wrote, the folder has the name."""
    return F.substring_index(path, "/", -2)


def list_landing(spark: SparkSession, path: str) -> DataFrame:
    """One row per file below a folder; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length", "modificationTime")
    )
    year, quarter = periods.period_in_name("path")
    named = files.withColumns(
        # a path is no URL: '#' and '?' belong to the name
        {"file_name": F.substring_index("path", "/", -1), "year": year, "quarter": quarter}
    )
    return named.withColumns(
        {
            "format": format_of("file_name"),
            "relevant": is_relevant(_shown("path"), F.col("year"), F.col("quarter")),
        }
    )


def latest_periods(df: DataFrame, n: int = 3) -> DataFrame:
    """The n newest (year, quarter) pairs of a table."""
    known = df.select("year", "quarter").filter(
        F.col("year").isNotNull() & F.col("quarter").isNotNull()
    )
    return known.distinct().orderBy(F.desc("year"), F.desc("quarter")).limit(n)


def keep_latest_periods(df: DataFrame, n: int = 3) -> DataFrame:
    """Rows of the n newest periods; the n pairs are the broadcast side."""
    return df.join(F.broadcast(latest_periods(df, n)), ["year", "quarter"], "left_semi")


def latest_snapshot(files: DataFrame, pattern: str = S.REGISTRY_FILES) -> DataFrame:
    """The last file by name among those that match."""
    named = files.filter(F.col("file_name").rlike(pattern))
    return named.orderBy(F.desc("file_name"), F.desc("path")).limit(1)
