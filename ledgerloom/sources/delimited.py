"""Delimited text with explicit all-text contracts, in UTF-8 or mixed encodings."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom import schema as S
from ledgerloom.session import materialize

SEPARATOR = ";"
QUOTE = '"'  # doubled inside a quoted field
FALLBACK_ENCODING = "ISO-8859-1"
NAMED_FILES = 10_000  # files that a scan is given by name


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    columns: Iterable[str],
    header: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """A UTF-8 file set whose header is known; every column is read as text.

    The header of each file is checked against ``columns``.  ``multi_line``
    accepts quoted line breaks; such files cannot be split.  Blank lines are no rows.
    """
    return (
        spark.read.schema(S.all_string(columns))
        .option("sep", SEPARATOR)
        .option("escape", QUOTE)
        .option("header", header)
        .option("enforceSchema", False)
        .option("multiLine", multi_line)
        .csv(path)
    )


def read_lines(
    spark: SparkSession,
    path: str | list[str],
    name_glob: str | None = None,
    keep: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """(src_file, raw, line_at): undecoded lines of splittable text files.

    ``keep`` is a condition on the file path; files it excludes are not opened.  As a filter
    it would also be evaluated for every line, so the files it chooses are named, unless they are very many.
    """

    def reader() -> DataFrameReader:
        wanted = spark.read
        return wanted.option("recursiveFileLookup", True).option("pathGlobFilter", name_glob) if name_glob else wanted

    kept = keep(F.col("_metadata.file_path")) if keep else F.lit(True)
    named = []
    if keep is not None:
        listed = reader().format("binaryFile").load(path).filter(kept)
        named = [r.path for r in listed.select("path").limit(NAMED_FILES + 1).collect()]
    if 0 < len(named) <= NAMED_FILES:
        files = reader().text([re.sub(r"([\\{}\[\]*?])", r"\\\1", p) for p in named])
    else:
        files = reader().text(path).filter(kept)
    return files.select(
        F.col("_metadata.file_path").alias("src_file"),
        F.col("value").cast("binary").alias("raw"),
        F.struct(
            F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("at")
        ).alias("line_at"),
    )


def decode(raw: Column | str, is_utf8: Column) -> Column:
    raw = F.col(raw) if isinstance(raw, str) else raw
    return F.when(is_utf8, raw.cast("string")).otherwise(F.decode(raw, FALLBACK_ENCODING))


def is_blank(raw: Column | str) -> Column:
    """Nothing but white space; decoding does not matter for that."""
    raw = F.col(raw) if isinstance(raw, str) else raw
    return F.btrim(raw.cast("string"), F.lit(" \t\r\f\v")) == ""  # looks no further than the first other character


# Fields as the parser sees them: a quote opens a field only at its beginning, and is doubled inside.
# Everything is possessive, so no line is gone over twice.
_INNER = '"[^"]*+(?:""[^"]*+)*+'
_QUOTED = f'{_INNER}"[^;]*+'
_FIELDS = f'(?:(?:{_QUOTED}|[^";][^;]*+|);)*+'
_LEFT_OPEN = f"{_INNER}$"


def leaves_open(raw: Column | str, inside: bool = False) -> Column:
    """Whether a line ends within a quoted field, if it begins outside one (or ``inside``)."""
    raw = F.col(raw) if isinstance(raw, str) else raw
    line, quote = raw.cast("string"), F.lit(QUOTE)
    if inside:
        return F.when(~F.contains(line, quote), True).otherwise(
            F.rlike(line, F.lit(f'(?s)^[^"]*+(?:""[^"]*+)*+(?:$|"[^;]*+;{_FIELDS}{_LEFT_OPEN})'))
        )
    return F.when(~F.contains(line, quote), False).otherwise(F.rlike(line, F.lit(f"(?s)^{_FIELDS}{_LEFT_OPEN}")))


# The same over many lines: what follows an unquoted field or a closing quote ends with the line.
_ENDED = f'{_INNER}"[^;\n]*+|[^";\n][^;\n]*+|'
_LINES_OPEN = f"^(?:(?:{_ENDED})[;\n])*+{_INNER}\\z"
_FIELD = f'(?:{_INNER}(?:"[^;\n]*+|\\z)|[^";\n][^;\n]*+|)'
_RECORD = f"{_FIELD}(?:;{_FIELD})*+"

# Lines that are looked at together, bytes of them as a rule and at most, and bytes (with what Spark
# keeps beside each line) for one task.
CHUNK_BITS = 12
CHUNK_BYTES = 1 << 20
LARGEST_CHUNK = 64 << 20
TASK_BYTES = 32 << 20
LINE_BYTES = 64


def join_records(lines: DataFrame, file_key: Iterable[str] = ("src_file",), tasks: int = 0) -> DataFrame:
    """One row per record: lines that break within quotes become one, with the first line's place.

    Whether a line begins within quotes depends on all lines before it.  Neighbouring lines of a split
    (at most ``2 ** CHUNK_BITS``, whatever the size of the file) are one text, which is a function of that
    state: it keeps, turns or sets it.  The functions are composed along the file; then each
    chunk's text is taken apart into records, and the pieces of a record that crosses chunks are put together.
    A file in which a quote is never closed stays as it is, every line a record, and its
    rows have ``unclosed``.  Every line break becomes a newline.

    ``tasks`` is the least number of tasks that the chunks are dealt to.
    """
    return _joined(lines, list(file_key), tasks, CHUNK_BITS)[0]


def _joined(lines: DataFrame, file_key: list[str], tasks: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """The records, and whether each file has an unclosed quote."""
    others = [c for c in lines.columns if c not in (*file_key, "raw", "line_at")]
    split = [*file_key, "_split", "_chunk"]
    tasks = max(tasks, int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    line = F.struct(F.col("line_at.at").alias("at"), F.coalesce(F.col("raw").cast("string"), F.lit("")).alias("raw"), *others)
    chunk = F.shiftright("line_at.at", bits).alias("_chunk")
    given = lines.select(*file_key, F.col("line_at.file_block_start").alias("_split"), chunk, line.alias("_line"))
    given = given.repartition(tasks, *split).groupBy(*split).agg(F.array_sort(F.collect_list("_line")).alias("_lines"))
    kept = F.transform("_lines", lambda x: F.struct(x["at"].alias("at"), *[x[c].alias(c) for c in others]))
    given = given.select(*split, kept.alias("_kept"), F.array_join(F.col("_lines")["raw"], "\n").cast("binary").alias("_bytes"))
    # one character for each byte, so that bytes of any encoding come out as they went in
    text = F.decode("_bytes", FALLBACK_ENCODING)
    inside, plain = F.concat(F.lit(QUOTE), "_text"), ~F.contains("_text", F.lit(QUOTE))
    given = given.withColumn("_text", text).withColumns(
        {
            "_f0": F.when(plain, False).otherwise(F.rlike("_text", F.lit(_LINES_OPEN))),
            "_f1": F.when(plain, True).otherwise(F.rlike(inside, F.lit(_LINES_OPEN))),
            # a record begins in it, even if its first line begins within quotes
            "_renews": F.when(plain, False).otherwise(F.rlike(inside, F.lit(f"^{_RECORD}\n"))),
        }
    )
    chunks = materialize(given.drop("_text"), "quote-chunks")
    along = Window.partitionBy(*file_key).orderBy("_split", "_chunk")
    through = along.rowsBetween(Window.unboundedPreceding, 0)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    ends = chunks.select(*split, "_f0", "_f1", "_renews").withColumn("_turned", F.sum((F.col("_f0") & ~F.col("_f1")).cast("int")).over(through))
    # the state that the last setting chunk leaves, and the turns counted since
    ends = ends.withColumn("_set", F.when(F.col("_f0") == F.col("_f1"), F.col("_f0").cast("int") + F.col("_turned")))
    closing = F.pmod(F.coalesce(F.last("_set", True).over(through), F.lit(0)) + F.col("_turned"), F.lit(2)) == 1
    ends = ends.withColumn("_closing", closing)
    at_begin = F.coalesce(F.lag("_closing").over(along), F.lit(False))
    at_end = F.last("_closing").over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ends = ends.withColumns({"_begin": at_begin, "unclosed": at_end})
    # where the record began that a chunk's first lines belong to
    own = F.struct("_split", "_chunk")
    carried = F.last(F.when(~F.col("_begin") | F.col("_renews"), own), True).over(before)
    ends = materialize(ends.select(*split, "_begin", "_closing", "unclosed", carried.alias("_carried")), "chunk-states")
    placed = chunks.repartition(tasks, *split).join(ends, split).withColumn("_text", text)
    whole = F.concat(F.when(F.col("_begin"), F.lit(f"\n{QUOTE}")).otherwise(F.lit("\n")), "_text")
    found = F.when(F.col("unclosed"), F.split("_text", "\n", -1)).otherwise(F.regexp_extract_all(whole, F.lit(f"\n({_RECORD})"), F.lit(1)))
    placed = placed.withColumn("_found", found).withColumn("_n", F.size("_found"))

    def by_line(record: Column, i: Column) -> Column:
        """A record at its first line, and nothing at its other lines."""
        head = F.col("_begin") & (i == 0) & ~F.col("unclosed")
        tail = F.col("_closing") & (i == F.col("_n") - 1) & ~F.col("unclosed")
        owner = F.when(head, F.col("_carried")).when(tail, own)
        # the quote that stands for the state at the beginning goes
        first = F.struct(F.when(head, F.substr(record, F.lit(2))).otherwise(record).alias("raw"), owner.alias("owner"))
        breaks = F.length(record) - F.length(F.replace(record, F.lit("\n"), F.lit("")))
        return F.when(F.instr(record, "\n") == 0, F.array(first)).otherwise(
            F.concat(F.array(first), F.array_repeat(F.when(F.lit(False), first), breaks))
        )

    lined = F.arrays_zip(F.col("_kept"), F.flatten(F.transform("_found", by_line)).alias("_record"))
    states = placed.select(*file_key, "_split", "unclosed", F.explode(lined).alias("_line")).select(
        *file_key,
        F.struct(F.col("_split").alias("file_block_start"), F.col("_line._kept.at").alias("at")).alias("line_at"),
        *[F.col(f"_line._kept.{c}").alias(c) for c in others],
        "unclosed",
        F.encode("_line._record.raw", FALLBACK_ENCODING).alias("raw"),
        F.col("_line._record.owner").alias("_owner"),
    )
    states = materialize(states, "quote-states").where(F.col("raw").isNotNull())
    columns = [*file_key, *others, "raw", "line_at", "unclosed"]
    # most records lie within a chunk: only the others are put together
    pieces = F.array_sort(F.collect_list(F.struct("line_at", F.col("raw").cast("string").alias("raw"))))
    joined = states.where("_owner IS NOT NULL").groupBy(*file_key, "_owner", "unclosed").agg(
        F.array_join(pieces["raw"], "\n").cast("binary").alias("raw"),
        F.min("line_at").alias("line_at"),
        *[F.min_by(c, "line_at").alias(c) for c in others],
    )
    joined = materialize(joined.select(columns), "records-over-chunks")
    unclosed = ends.groupBy(*file_key).agg(F.bool_or("unclosed").alias("unclosed"))
    return states.where("_owner IS NULL").select(columns).unionByName(joined), unclosed


def describe_files(lines: DataFrame, file_key: Iterable[str] = ("src_file",)) -> DataFrame:
    """One row per file: is every line valid UTF-8, its first line, where that is,
    whether any line ends within quotes (``opens``) and that one does (``header_opens``), and the
    number of lines, their bytes and the longest's.

    Blank lines before the header are passed over.

    A file is read as UTF-8 as a whole or as Latin-1 as a whole, so all its
    lines are looked at; both aggregates are combined map side, so the shuffle
    carries one row per file and task.  A set of at most two booleans, rather
    than ``bool_and``, makes this an object hash aggregate: with a text buffer
    alone the lines would be sorted by file first.
    """
    valid = F.collect_set(F.is_valid_utf8(F.col("raw").cast("string")))
    filled = F.when(~is_blank("raw"), F.col("line_at"))
    return (
        lines.groupBy(*file_key)
        .agg(
            valid.alias("_valid"),
            F.min_by("raw", filled).alias("_first"),
            F.min(filled).alias("header_at"),
            F.bool_or(leaves_open("raw")).alias("opens"),
            F.count(F.lit(1)).alias("n_lines"),
            F.sum(F.octet_length("raw")).alias("n_bytes"),
            F.max(F.octet_length("raw")).alias("longest"),
        )
        .withColumn("header_opens", leaves_open("_first"))
        .withColumn("is_utf8", ~F.array_contains("_valid", False))
        .withColumn("header_line", decode("_first", F.col("is_utf8")))
        .drop("_first", "_valid")
    )


def split_header(header_line: Column | str, join_words: bool = True) -> Column:
    """The cleaned header names of a file as an array."""
    line = F.col(header_line) if isinstance(header_line, str) else header_line
    plain = F.regexp_replace(F.lower(line), '^\ufeff|"', "")
    names = F.transform(
        F.split(plain, SEPARATOR), lambda n: F.regexp_replace(n, r"^\s+|\s+$", "")
    )
    return F.transform(names, lambda n: F.replace(n, F.lit(" "), F.lit("_"))) if join_words else names


def split_line(line: Column | str, width: int) -> Column:
    """The fields of a line as an array of ``width`` texts, NULL where missing."""
    line = F.col(line) if isinstance(line, str) else line
    fields = [f"c{i}" for i in range(width)]
    parsed = F.from_csv(line, ", ".join(f"{f} string" for f in fields), {"sep": SEPARATOR, "escape": QUOTE})
    return F.array(*[parsed[f] for f in fields])


def too_wide(line: Column | str, n_names: Column) -> Column:
    """More fields than the header has names; empty fields at the end, quoted or not, do not count.

    Only a line with as many separators as the header has names can be: others are not parsed for it.
    """
    line = F.col(line) if isinstance(line, str) else line
    separators = F.length(line) - F.length(F.replace(line, F.lit(SEPARATOR), F.lit("")))
    filled = F.regexp_replace(line, r'(?:;(?:"")?\s*+)+$', "")
    fields = F.regexp_count(filled, F.lit(f"(?s)(?:^|;)(?:{_QUOTED}|[^;]*+)"))
    return F.when(separators < n_names, False).otherwise(fields > n_names)


def places(names: Column, aliases: Iterable[str]) -> Column:
    """Where a file has the alias headers, in the order of the aliases; for one row per file."""
    accepted = F.array(*[F.lit(a) for a in aliases])
    return F.filter(F.transform(accepted, lambda a: F.array_position(names, a)), lambda at: at > 0)


def field(values: Column, at: Iterable[Column]) -> Column:
    """The first value that is not NULL under the headers at these places, NULL where there is no place."""
    return F.coalesce(F.lit(None).cast("string"), *[F.get(values, place - 1) for place in at])


def parse_files(
    lines: DataFrame,
    files: DataFrame,
    aliases: Mapping[str, Iterable[str]],
    width: int,
    keep: Iterable[str] = (),
    file_key: Iterable[str] = ("src_file",),
) -> DataFrame:
    """Text columns by header alias, for files of any mix of layouts, in one plan.

    Each line (or record) is matched with its own file's header (``files``, one row per
    file), so layouts need no scan of their own.  The header line itself and blank
    lines are not data.  A line with more fields than the header is kept out of no
    result: its ``malformed`` has the line and its columns are NULL.

    Headers are looked up once for a file, not for each of its lines, and what every line is joined with are
    plain numbers: as many places of a column as any file has.
    """
    file_key, keep = list(file_key), list(keep)
    found = {column: places(F.col("names"), names) for column, names in aliases.items()}
    most = files.agg(*[F.coalesce(F.max(F.size(at)), F.lit(0)).alias(c) for c, at in found.items()]).first()
    at = {c: {f"_at_{c}_{i}": F.get(found[c], F.lit(i)).cast("int") for i in range(most[c])} for c in found}
    placed = files.select(
        *file_key, *{"header_at", "is_utf8", *(k for k in keep if k in files.columns)}, F.size("names").alias("_n_names"),
        *[place.alias(name) for named in at.values() for name, place in named.items()],
    )
    rows = lines.join(placed, file_key).withColumn("_line", decode("raw", F.col("is_utf8")))
    body = rows.filter((F.col("line_at") != F.col("header_at")) & ~is_blank("raw"))
    wide = F.when(too_wide("_line", F.col("_n_names")), F.col("_line"))
    values = body.withColumn("malformed", wide).withColumn("_values", split_line("_line", width))
    columns = [
        F.when(F.col("malformed").isNull(), field(F.col("_values"), [F.col(name) for name in at[column]])).alias(column)
        for column in aliases
    ]
    return values.select(*file_key, *columns, "malformed", *keep)


def header_width(files: DataFrame) -> int:
    """The largest number of columns any file has."""
    return files.agg(F.coalesce(F.max(F.size("names")), F.lit(1))).first()[0]


def whole_records(lines: DataFrame, file_key: Iterable[str], describe: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """The records of all files, and the stored description of the files with ``unclosed``.

    Files without a line that ends within quotes, which most are, are read as they are; the
    lines of the others are put together first and described again.
    """
    file_key = list(file_key)
    described = describe(describe_files(lines, file_key)).withColumn("unclosed", F.lit(False))
    files = materialize(described, "files")
    sizes = files.where("opens").agg(F.sum("n_lines"), F.sum("n_bytes"), F.max("longest")).first()
    if sizes[0] is None:
        return lines, files
    n_lines, n_bytes, longest = sizes
    opening = materialize(files.where("opens").select(*file_key), "files-with-breaks")
    others = None if files.where("NOT opens").isEmpty() else lines.join(opening, file_key, "left_anti")
    opened = lines if others is None else lines.join(opening, file_key, "left_semi")
    together = min(CHUNK_BYTES * n_lines // max(n_bytes, 1), LARGEST_CHUNK // max(longest, 1))
    bits = min(CHUNK_BITS, max(together, 1).bit_length() - 1)
    records, unclosed = _joined(opened, file_key, -(-(n_bytes + LINE_BYTES * n_lines) // TASK_BYTES), bits)
    records = records.drop("unclosed")
    # only a header of several lines reads otherwise now
    files = files.drop("unclosed").join(unclosed, file_key, "left").withColumn("unclosed", F.coalesce("unclosed", F.lit(False)))
    files = materialize(files, "files")
    broken = files.where("header_opens AND NOT unclosed").select(*file_key)
    if not broken.isEmpty():
        broken = materialize(broken, "files-with-broken-headers")
        again = describe(describe_files(records.join(broken, file_key, "left_semi"), file_key)).withColumn("unclosed", F.lit(False))
        files = materialize(files.join(broken, file_key, "left_anti").unionByName(again), "files")
    return records if others is None else others.unionByName(records), files


def read_mixed_encoding(
    spark: SparkSession,
    path: str | list[str],
    aliases: Mapping[str, Iterable[str]],
    join_words: bool = True,
) -> DataFrame:
    """Delimited files, each in UTF-8 or Latin-1, read by header alias.

    ``src_file`` and ``line_at`` give the order of the rows.  Quoted fields may hold line breaks, also
    across the splits of a file.  Records too wide for their header have ``malformed``.
    """
    lines = read_lines(spark, path)
    records, files = whole_records(
        lines, ["src_file"], lambda d: d.withColumn("names", split_header("header_line", join_words))
    )
    return parse_files(records, files, aliases, header_width(files), keep=["line_at"])
