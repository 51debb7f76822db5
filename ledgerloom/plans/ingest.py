"""From a landing folder to one flagged expense table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import schema as S
from ledgerloom.functions import ids, numbers, periods, text
from ledgerloom.operators import dedupe, filters, joins, quality
from ledgerloom.session import materialize
from ledgerloom.sources import archives, delimited, landing

FILE_KEY = ("src_file", "entry")
SPLIT_LINES = 1_000_000  # lines of an archive's entry that are one split
TASK_ROWS = 250_000  # rows that one task makes distinct before they are sent
AMBIGUOUS = "several columns for one standard column"
TOO_WIDE = "more fields than the header"
NO_DESCRIPTION = "ledger without description"
NO_KNOWN_COLUMN = "no known column"
UNCLOSED = "a quote is never closed"


@dataclass(frozen=True)
class Ingested:
    """The consolidated rows, and the files and lines that could not be read with the reason.

    ``rows`` are the flagged rows, with the number of their file, before equal ones become one.
    """

    expense: DataFrame
    rejects: DataFrame
    rows: DataFrame


def read_registry(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Registry files in either encoding; the first line of a registration wins.

    ``src_file`` and ``line_at`` stay, so that "first" means file order later on, too.  Give
    the newest snapshot (``newest_registry``) where a folder holds several.
    """
    raw = delimited.read_mixed_encoding(spark, path, S.REGISTRY_ALIASES, join_words=False)
    cleaned = raw.withColumns(
        {
            "registration": F.trim("registration"),
            "entity_id": ids.digits_only("entity_id"),
        }
    ).filter(F.col("registration").isNotNull() & F.col("malformed").isNull())
    first = dedupe.keep_first(cleaned, ["registration"], S.FILE_ORDER)
    return first.select(*S.REGISTRY_COLUMNS, *S.FILE_ORDER)


def newest_registry(spark: SparkSession, folder: str) -> DataFrame:
    """The registry as its newest snapshot in a folder has it."""
    newest = landing.latest_snapshot(landing.list_landing(spark, folder)).collect()  # one row at most
    if not newest:
        raise ValueError(f"no registry file in {folder}")
    return read_registry(spark, newest[0].path)


def _by_registration(registry: DataFrame) -> DataFrame:
    """One (registration, id, name) row per registration number."""
    numbered = registry.withColumn("registration", ids.registration_key("registration"))
    unique = dedupe.keep_first(numbered, ["registration"], S.registry_order(numbered))
    return unique.select(
        "registration",
        F.col("entity_id").alias("found_id"),
        F.col("entity_name").alias("found_name"),
    )


def registrations(registry: DataFrame) -> DataFrame:
    """A registry as lookups need it, stored; to be made once where there are several of them."""
    return registry if "found_id" in registry.columns else joins.sized_side(_by_registration(registry), "registrations")


def look_up_registration(rows: DataFrame, registry: DataFrame, spread_by: Sequence[str] = ("amount",)) -> DataFrame:
    """Add ``found_id`` and ``found_name``, NULL where the registration is unknown.

    Rows without a registration are spread by the columns ``spread_by``.  The registry may be one of ``registrations``.
    """
    return joins.lookup(
        rows,
        registrations(registry),
        ids.registration_key("registration"),
        F.col("registration"),
        ["found_id", "found_name"],
        spread_by,
    )


def from_ledger(ledger: DataFrame, registry: DataFrame) -> DataFrame:
    """Expense lines of a ledger, with id and name looked up by registration.

    Needs ``registration, description, amount`` as text and the period columns;
    one row per line.
    """
    wanted = filters.ledger_lines(ledger, "description")
    parsed = wanted.withColumn("amount", numbers.comma_decimal("amount"))
    others = [c for c in ledger.columns if c not in ("registration", "description", "amount")]
    return look_up_registration(parsed, registry).select(
        F.col("found_id").alias("entity_id"),
        F.col("found_name").alias("entity_name"),
        *others,
        "amount",
    )


def clean(df: DataFrame) -> DataFrame:
    """Strip texts, clean ids, coerce amounts and periods that are still text."""
    types = dict(df.dtypes)

    def coerced(column: str, parse: Callable[[str], Column], kind: str) -> Column:
        return parse(column) if types[column] == "string" else F.col(column).cast(kind)

    return df.withColumns(
        {
            "entity_id": ids.digits_only("entity_id"),
            "entity_name": text.strip_whitespace("entity_name"),
            "amount": coerced("amount", numbers.to_decimal, "decimal(18,2)"),
            "quarter": coerced("quarter", numbers.to_whole, "int"),
            "year": coerced("year", numbers.to_whole, "int"),
        }
    )


def consolidate(flagged: DataFrame) -> DataFrame:
    """Distinct rows of all files, newest period first, then by id.

    The remaining columns end the order, so that rows of one hot id can still
    be spread over several sorted partitions.
    """
    rows = dedupe.distinct_rows(flagged.select(*S.EXPENSE_COLUMNS, "issue_flags"))
    return rows.orderBy(
        F.col("year").desc_nulls_last(),
        F.col("quarter").desc_nulls_last(),
        F.col("entity_id").asc_nulls_last(),
        "entity_name",
        "amount",
        "issue_flags",
    )


def _names_any(names: Column, aliases: tuple[str, ...]) -> Column:
    return F.arrays_overlap(names, F.array(*[F.lit(a) for a in aliases]))


def _given_twice(names: Column, aliases: Mapping[str, tuple[str, ...]]) -> Column:
    def hits(accepted: tuple[str, ...]) -> Column:
        return F.filter(names, lambda n: n.isin(*accepted))

    several = F.lit(False)
    for accepted in aliases.values():
        several = several | (F.size(hits(accepted)) > 1)
    return several


def describe_layouts(described: DataFrame) -> DataFrame:
    """Per file: header names, layout, period, and the reason to reject it if any."""
    names = F.col("names")
    ledger = _names_any(names, S.LEDGER_ALIASES["registration"])
    known = F.lit(False)
    for accepted in S.EXPENSE_ALIASES.values():
        known = known | _names_any(names, accepted)
    year, quarter = periods.period_in_name(F.concat_ws("/", "src_file", "entry"))
    return (
        described.withColumn("names", delimited.split_header("header_line"))
        .withColumns(
            {
                "is_ledger": ledger,
                "file_year": year,
                "file_quarter": quarter,
            }
        )
        .withColumn(
            "problem",
            F.when(
                F.col("is_ledger") & ~_names_any(names, S.LEDGER_ALIASES["description"]),
                F.lit(NO_DESCRIPTION),
            )
            .when(F.col("is_ledger"), F.lit(None).cast("string"))
            .when(_given_twice(names, S.EXPENSE_ALIASES), F.lit(AMBIGUOUS))
            .when(~known, F.lit(NO_KNOWN_COLUMN)),
        )
    )


def _spread(rows: DataFrame) -> DataFrame:
    """A stored table's rows in tasks of about ``TASK_ROWS``, equal ones in different tasks.

    How many rows a scan hands to a task follows from the size of files; what is
    grouped there before a shuffle is held by row.
    """
    n = rows.count()
    if n <= TASK_ROWS:
        return rows
    tasks = max(-(-n // TASK_ROWS), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(tasks, F.monotonically_increasing_id())


def ingest_lines(lines: DataFrame, registry: DataFrame) -> Ingested:
    """``src_file, entry, raw, line_at`` of any mix of layouts to flagged expenses.

    The lines are read twice: once to describe the files, once to parse both
    layouts side by side and route each row by the layout of its file.  Lines that break within
    quotes are one record; a file that never closes a quote is rejected.
    """
    records, files = delimited.whole_records(lines, FILE_KEY, describe_layouts)
    # rows carry the number of their file, not its path
    files = files.withColumns(
        {
            "problem": F.when(F.col("unclosed"), F.lit(UNCLOSED)).otherwise(F.col("problem")),
            "file_no": F.monotonically_increasing_id(),
            **{f"gives_{c}": _names_any(F.col("names"), S.EXPENSE_ALIASES[c]) for c in ("quarter", "year")},
        }
    )
    files = materialize(files, "numbered-files")
    usable = files.filter(F.col("problem").isNull())
    ledger_columns = {f"ledger_{c}": names for c, names in S.LEDGER_ALIASES.items()}
    parsed = delimited.parse_files(
        records,
        usable,
        {**S.EXPENSE_ALIASES, **ledger_columns},
        delimited.header_width(files),
        ["file_no", "is_ledger", "file_year", "file_quarter", "gives_quarter", "gives_year"],
        FILE_KEY,
    )
    is_ledger = F.coalesce("is_ledger", F.lit(False))
    wanted = text.contains_any("ledger_description", S.LEDGER_WORDS)
    wide = F.col("malformed").isNotNull()
    kept = parsed.filter(~is_ledger | wanted | wide)

    def period(column: str) -> Column:
        return F.when(~is_ledger & F.col(f"gives_{column}"), numbers.to_whole(column)).otherwise(F.col(f"file_{column}"))

    amount = F.when(is_ledger, F.col("ledger_amount")).otherwise(F.col("amount"))
    typed = kept.select(
        "file_no",
        is_ledger.alias("is_ledger"),
        "entity_id",
        "entity_name",
        period("quarter").alias("quarter"),
        period("year").alias("year"),
        numbers.comma_decimal(amount).alias("amount"),
        F.when(is_ledger, F.col("ledger_registration")).alias("registration"),
        "malformed",
    )
    # flagging needs the rows twice: from here on they are columns, not text
    stored = materialize(clean(typed), "parsed")
    columns = ["file_no", "entity_id", "entity_name", "quarter", "year", "amount", "malformed"]
    # only lines of ledgers have a registration; the others need not be dealt out for the lookup.
    # The amount alone would not spread files that have none
    found = look_up_registration(stored.filter("is_ledger").drop("entity_id", "entity_name"), registry, ["amount", "file_no", "year"])
    found = found.withColumnsRenamed({"found_id": "entity_id", "found_name": "entity_name"})
    rows = stored.filter("NOT is_ledger").select(columns).unionByName(materialize(clean(found).select(columns), "looked-up"))
    good = rows.filter(F.col("malformed").isNull()).drop("malformed")
    flagged = quality.flag_issues(good, ["file_no", "entity_id"], _spread)
    no_line = F.lit(None).cast("string").alias("line")
    rejects = files.filter(F.col("problem").isNotNull()).select(*FILE_KEY, "problem", no_line)
    lines_out = rows.filter(F.col("malformed").isNotNull()).join(files.select("file_no", *FILE_KEY), "file_no").select(
        *FILE_KEY, F.lit(TOO_WIDE).alias("problem"), F.col("malformed").alias("line")
    )
    return Ingested(consolidate(flagged), rejects.unionByName(lines_out), flagged)


def ingest_landing(
    spark: SparkSession, folder: str, registry: DataFrame, n_periods: int = 3
) -> Ingested:
    """The relevant files of the newest periods of a landing folder, as one table."""
    relevant = landing.list_landing(spark, folder).filter("relevant")
    # only the n periods come to the driver; the readers apply them to their file lists
    newest = [tuple(p) for p in landing.latest_periods(relevant, n_periods).collect()]
    if not newest:
        raise ValueError(f"no relevant file of a known period in {folder}")

    def keep(path: Column) -> Column:
        return landing.is_chosen(path, newest)

    plain = delimited.read_lines(spark, folder, landing.TEXT_FILES, keep)
    # an archive is read by one task; writing its lines once makes every later
    # pass splittable
    unpacked = materialize(archives.read_archives(spark, folder, keep), "archives")
    good, bad = archives.split_problems(unpacked)
    # line numbers in blocks stand for the splits of a file
    block = F.floor(F.col("line_no") / SPLIT_LINES) * SPLIT_LINES
    at = F.struct(block.cast("bigint").alias("file_block_start"), F.col("line_no").alias("at"))
    lines = dedupe.union_aligned(
        [
            plain.withColumn("entry", F.lit("")),
            good.select("src_file", "raw", at.alias("line_at"), "entry"),
        ]
    )
    done = ingest_lines(lines, registry)
    readable = F.coalesce(F.col("format"), F.lit("")).isin("csv", "archive")
    unsupported = relevant.filter(keep(F.col("path")) & ~readable).select(
        F.col("path").alias("src_file"),
        F.lit("").alias("entry"),
        F.lit(archives.UNSUPPORTED).alias("problem"),
    )
    damaged = bad.withColumn("entry", F.coalesce("entry", F.lit("")))
    return Ingested(done.expense, dedupe.union_aligned([done.rejects, unsupported, damaged]), done.rows)
