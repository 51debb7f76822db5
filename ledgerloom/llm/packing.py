"""Packing into fixed-length sequences: shortest-pack-first over the length histogram.

Every document's ids, closed by an end id, are cut into full sequences and one rest.
The histogram of the rests (at most ``limit`` bins, however many documents there are) is
packed on the driver: lengths from the longest to the shortest, each into the pack with most
room, as counts of packing patterns.  Patterns are then joined back to the documents by rank:
the r-th rest of a length takes the r-th slot of that length.  Ranks are numbered in
slices, so that a length which a third of the rests have is not sorted in one task.

Nulls and edges: a null or empty text is its end id alone.  Rows that repeat an id, or
have none, are packed as documents of their own.  Other columns are not read.  An
empty table gives an empty result.  Which of two rests of equal length comes first follows from
id, start and ids, so reruns agree.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.bpe import encode_batch, vocabulary_path
from ledgerloom.llm.common import by_value, ranked, stored, task_count
from ledgerloom.llm.words import by_size

by_value(__name__)

AT_ONCE = 6 << 20  # bytes of text that are encoded together
RANK_BITS = 48  # ranks of one length stay below 2 ** 48


def cut_pieces(
    docs: DataFrame, path: str | None = None, limit: int = 2048, end_id: int = 1, with_ids: bool = False,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens (and the ids themselves)."""
    path = path or vocabulary_path()

    def run(batches):
        for batch in by_size(batches, 1, AT_ONCE):
            names = batch.column(0).to_pylist()
            out = [[] for _ in range(6 if with_ids else 5)]
            for name, ids in zip(names, encode_batch(batch.column(1), path), strict=True):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for start in range(0, len(ids), limit):
                    piece = ids[start : start + limit]
                    row = (name, start, len(piece), zlib.crc32(piece), len(ids), piece)
                    for column, value in zip(out, row, strict=False):
                        column.append(value)
            kinds = [pa.int64()] * 5 + [pa.list_(pa.int32())] * with_ids
            if with_ids:
                out[5] = [x.astype(np.int32) for x in out[5]]
            labels = ["id", "start", "length", "ids_crc32", "doc_tokens", "ids"][: len(out)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=labels)

    schema = "id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, schema)


def shortest_pack_first(histogram: dict[int, int], limit: int) -> list[tuple[int, list[int]]]:
    """(count, lengths of a pack) for all packs; lengths longest first, most room first."""
    open_packs: dict[int, list[tuple[int, list[int]]]] = {}
    for length in sorted(histogram, reverse=True):
        left, room = histogram[length], limit
        grown: list[tuple[int, int, list[int]]] = []
        while left:
            while room >= length and not open_packs.get(room):
                room -= 1
            if room < length:  # nothing open has room: new packs of as many of this length as fit
                each = limit // length
                full, rest = divmod(left, each)
                if full:
                    grown.append((limit - each * length, full, [length] * each))
                if rest:
                    grown.append((limit - rest * length, 1, [length] * rest))
                left = 0
                continue
            count, pack = open_packs[room].pop()
            used = min(count, left)
            if used < count:
                open_packs[room].append((count - used, pack))
            left -= used
            space, bigger = room - length, [*pack, length]
            # goes back at once: it may well be the roomiest pack again
            open_packs.setdefault(space, []).append((used, bigger))
        for space, count, pack in grown:
            open_packs.setdefault(space, []).append((count, pack))
    return [entry for space in sorted(open_packs) for entry in open_packs[space]]


def slots(packs: list[tuple[int, list[int]]]) -> dict[str, np.ndarray]:
    """By length and first rank: the first sequence and the offset of every run of slots."""
    rows, taken, sequence = [], {}, 0
    for count, pack in packs:
        offset = 0
        for length in pack:
            first = taken.get(length, 0)
            rows.append(((length << RANK_BITS) + first, first, sequence, offset))
            taken[length] = first + count
            offset += length
        sequence += count
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 4).T
    return dict(zip(("key", "first", "sequence", "offset"), columns, strict=True))


def pack(pieces: DataFrame, limit: int = 2048) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; within a sequence there is no gap."""
    pieces = stored(pieces, "pieces")
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = slots(shortest_pack_first(histogram, limit))
    order = ["id", "start", "ids_crc32", "doc_tokens"]
    # salted by all of these, so that documents without an id are spread as well
    numbered = ranked(pieces, ["length"], order, F.xxhash64(*order), "_rank", 4 * task_count(pieces))
    fields = numbered.schema.fields
    names = [f.name for f in fields if f.name != "_rank"]

    def run(batches):
        for batch in batches:
            length = batch.column(names.index("length")).to_numpy()
            rank = batch.column(len(names)).to_numpy()
            at = np.searchsorted(table["key"], (length << RANK_BITS) + rank, side="right") - 1
            added = [table["sequence"][at] + rank - table["first"][at], table["offset"][at]]
            columns = [batch.column(i) for i in range(len(names))] + [pa.array(x, pa.int64()) for x in added]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields if f.name != "_rank")
    return numbered.mapInArrow(run, schema + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str | None = None, limit: int = 2048, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    return pack(cut_pieces(docs, path, limit, end_id, with_ids), limit).withColumnRenamed("id", "doc_id")
