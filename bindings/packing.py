"""Archives made from lines, for the archive query."""

from __future__ import annotations

import io
import sys
import uuid
import zipfile

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext, cloudpickle

LEDGER_HEADER = "REG_ANS;DESCRICAO;VL_SALDO_FINAL"
ARCHIVE_LINES = 10_000

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def pack_batches(batches):
    """One archive per Arrow batch of lines: a folder entry and one text entry."""
    for batch in batches:
        body = "\n".join([LEDGER_HEADER, *batch.column("line").to_pylist()]).encode()
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("sub/", "")
            archive.writestr("sub/ledger.csv", body)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([f"{uuid.uuid4().hex}.zip"], pa.string()),
                pa.array([packed.getvalue()], pa.binary()),
            ],
            names=["path", "content"],
        )


def _store(place: str, name: str, content: bytes) -> None:
    target, folder = fs.FileSystem.from_uri(place if "://" in place else place.replace("file:", "file://", 1))
    target.create_dir(folder, recursive=True)
    with target.open_output_stream(f"{folder}/{name}") as out:
        out.write(content)


def write_files(batches):
    """(place, name, line) rows: each line is a file."""
    for batch in batches:
        for row in batch.to_pylist():
            _store(row["place"], row["name"], row["line"].encode())
        yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["files"])


def write_archives(batches):
    """(place, name, line) rows in any order: up to ``ARCHIVE_LINES`` lines under one name are one archive.

    Archives are numbered by task and within it, so that tasks may share a name and a
    repeated task writes the same files.
    """
    task, pending, written = TaskContext.get().partitionId(), {}, {}

    def store(key):
        place, name = key
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("pasta é/ledger %.csv", "\n".join([LEDGER_HEADER, *pending.pop(key)]).encode())
        written[key] = written.get(key, 0) + 1
        _store(place, f"{task}-{written[key]} {name}", packed.getvalue())

    for batch in batches:
        for place, name, line in zip(*(batch.column(c).to_pylist() for c in ("place", "name", "line")), strict=True):
            lines = pending.setdefault((place, name), [])
            lines.append(line)
            if len(lines) == ARCHIVE_LINES:
                store((place, name))
    for key in list(pending):
        store(key)
    yield pa.RecordBatch.from_arrays([pa.array([sum(written.values())], pa.int64())], names=["files"])
