"""ZIP archives: one row per line of every delimited entry, each entry in a task of its own."""

from __future__ import annotations

import io
import lzma
import pickle
import struct
import sys
import zipfile
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The task functions travel with the job: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BATCH_LINES = 20_000

LINES_SCHEMA = "src_file string, entry string, line_no long, raw binary, problem string"
_ARROW = pa.schema(
    [
        ("src_file", pa.string()),
        ("entry", pa.string()),
        ("line_no", pa.int64()),
        ("raw", pa.binary()),
        ("problem", pa.string()),
    ]
)

# What a damaged, encrypted or unknown archive raises.  Read errors of the file
# system are not among them: those fail the task, so that Spark repeats it.
DAMAGED = (zipfile.BadZipFile, zlib.error, lzma.LZMAError, EOFError, RuntimeError)

TEXT_SUFFIXES = (".csv", ".txt")
NOT_AN_ARCHIVE = "not a readable archive"
UNSUPPORTED = "unsupported format"


def _batch(src: str, entry: str | None, first: int, raw: list[bytes], problem: str | None = None):
    n = len(raw)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([src] * n, pa.string()),
            pa.array([entry] * n, pa.string()),
            pa.array(range(first, first + n), pa.int64()),
            pa.array(raw, pa.binary()),
            pa.array([problem] * n, pa.string()),
        ],
        schema=_ARROW,
    )


ENTRIES_SCHEMA = "src_file string, entry string, info binary, packed binary, problem string"
_ENTRY_ARROW = pa.schema(
    [
        ("src_file", pa.string()),
        ("entry", pa.string()),
        ("info", pa.binary()),
        ("packed", pa.binary()),
        ("problem", pa.string()),
    ]
)


def _entry(src: str, name: str | None, info: bytes | None, packed: bytes | None, problem: str | None):
    values = ([src], [name], [info], [packed], [problem])
    return pa.RecordBatch.from_arrays(
        [pa.array(v, f.type) for v, f in zip(values, _ENTRY_ARROW, strict=True)], schema=_ENTRY_ARROW
    )


def _archive_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per entry, still packed: the archive's bytes from its header to the next one's."""
    for batch in batches:
        for src, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
            raw = content.as_buffer() if content.is_valid else pa.py_buffer(b"")
            try:
                with zipfile.ZipFile(pa.BufferReader(raw)) as archive:
                    infos, end = archive.infolist(), archive.start_dir
            except DAMAGED:
                yield _entry(src, None, None, None, NOT_AN_ARCHIVE)
                continue
            starts = sorted({i.header_offset for i in infos} | {end})
            ends = dict(zip(starts, starts[1:], strict=False))
            view = memoryview(raw)
            for info in infos:
                if info.is_dir():
                    continue
                if not info.filename.lower().endswith(TEXT_SUFFIXES):
                    yield _entry(src, info.filename, None, None, UNSUPPORTED)
                    continue
                first = info.header_offset
                packed = bytes(view[first : ends.get(first, end)])
                yield _entry(src, info.filename, pickle.dumps(info), packed, None)


def _entry_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream the lines of entries; a damaged one ends in a problem row."""
    for batch in batches:
        for row in batch.to_pylist():
            src, name = row["src_file"], row["entry"]
            if row["problem"]:
                yield _batch(src, name, 0, [b""], row["problem"])
                continue
            first, pending = 1, []
            try:
                with _open_entry(pickle.loads(row["info"]), row["packed"]) as stream:
                    for line in stream:
                        pending.append(line.rstrip(b"\r\n"))
                        if len(pending) == BATCH_LINES:
                            yield _batch(src, name, first, pending)
                            first, pending = first + BATCH_LINES, []
                if pending:
                    yield _batch(src, name, first, pending)
            except DAMAGED:
                yield _batch(src, None, 0, [b""], NOT_AN_ARCHIVE)


def _open_entry(info: zipfile.ZipInfo, packed: bytes) -> zipfile.ZipExtFile:
    """The entry's text, inflated as it is read and checked at its end."""
    if info.flag_bits & 1 or len(packed) < 30:
        raise zipfile.BadZipFile(info.filename)
    name, extra = struct.unpack_from("<HH", packed, 26)  # of the local header
    return zipfile.ZipExtFile(io.BytesIO(packed[30 + name + extra :]), "r", info)


def expand_archives(archives: DataFrame) -> DataFrame:
    """(path, content) rows to line rows.

    An archive's directory is read by one task; its entries are dealt out, and each is
    inflated once, in a task of its own.
    """
    entries = archives.select("path", "content").mapInArrow(_archive_entries, ENTRIES_SCHEMA)
    dealt = entries.repartition(F.xxhash64("src_file", "entry"))
    return dealt.mapInArrow(_entry_lines, LINES_SCHEMA)


def read_archives(
    spark: SparkSession,
    path: str | list[str],
    keep: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Line rows of all archives under a path.

    ``keep`` is a condition on the file path, applied to the file list.  An archive is a
    binary value, so one above 2 GB fails with Spark's error about its length.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.[zZ][iI][pP]")
        .option("recursiveFileLookup", True)
        .load(path)
    )
    if keep is not None:
        files = files.filter(keep(F.col("_metadata.file_path")))
    return expand_archives(files)


def split_problems(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(line rows, reject rows); an archive with a damaged entry is rejected as a whole.

    Both read ``lines``, so pass a stored table.
    """
    bad = lines.filter(F.col("problem").isNotNull()).select("src_file", "entry", "problem").distinct()
    damaged = bad.filter(F.col("problem") == NOT_AN_ARCHIVE).select("src_file").distinct()
    good = lines.filter(F.col("problem").isNull()).drop("problem")
    rest = bad.join(damaged.withColumnRenamed("src_file", "_bad"), F.col("src_file") == F.col("_bad"), "left")
    kept = rest.filter(F.col("_bad").isNull() | (F.col("problem") == NOT_AN_ARCHIVE)).drop("_bad")
    return good.join(damaged, "src_file", "left_anti"), kept
