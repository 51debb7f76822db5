"""Substring de-duplication by content-defined chunks.

A gear hash rolls over the last 16 bytes of every text.  A blank at which its upper bits are zero
is a cut, unless another lies shortly before it, so a cut depends on the bytes near it alone and
an insertion moves no cut but those around it.  Every chunk has a digest; what is looked up are runs: the
fewest chunks, one after another, that reach ``least_words`` words, or ``least_bytes``
bytes where a script has no blanks, from each chunk on and up to each chunk.  A run is known by the joint digest of its chunks.  Its first holder (smallest id, then
smallest offset) keeps it, and all others lose it: so only what occurred as a whole before ever goes, and
common short chunks remove nothing.  Runs that overlap go as one span.

Digests are counted with map-side combine; runs whose digest occurs again meet their holder, the few digests that
many documents share by a broadcast of bounded size.

Nulls and edges: null and empty texts have no chunks.  Rows without an id are left alone, and so
are rows of an id that names different texts.  Rows that repeat an id and its text are one document.
Empty tables give empty results, and columns other than id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.common import HELD, beside, by_value, stored, unused
from ledgerloom.llm.words import by_size
from ledgerloom.session import settled

by_value(__name__)

AT_ONCE = 4 << 20  # bytes of text whose chunks are collected together
WINDOW = 16  # bytes the rolling hash sees
SLAB = 1 << 20  # bytes hashed at once
SHIFT = 15  # lower bits do not depend on all of the window
BLANK_BITS = 2  # one blank in four is a candidate
ANY_BITS = 10  # elsewhere one character in a thousand, so that a text without blanks is cut
APART = 12  # a candidate with another in the 12 bytes before it is none
PRIME = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse
HOT = 512  # digests with more than this part of all runs are met by broadcast


def gear_table(seed: int = 20) -> np.ndarray:
    """One 32-bit number per byte, from a seeded generator."""
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 32, 256, dtype=np.uint32)


GEAR = gear_table()


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """At each byte the sum of gear values of the last 16 bytes, each shifted by its age."""
    h = GEAR[data]
    for step in (1, 2, 4, 8):
        older = h[:-step] << np.uint32(step)
        h = h.copy()
        h[step:] += older
    return h


def cut_places(data: np.ndarray) -> np.ndarray:
    """Offsets of chunk ends, the end of the text included."""
    found = []
    for at in range(0, len(data), SLAB):
        back = min(at, WINDOW)
        part = data[at - back : at + SLAB]
        h = (rolling_hash(part) >> np.uint32(SHIFT))[back:]
        part = part[back:]
        blank = (part == 0x20) | ((part >= 0x09) & (part <= 0x0D))
        low = (h & np.uint32((1 << BLANK_BITS) - 1)) == 0
        rare = (h & np.uint32((1 << ANY_BITS) - 1)) == 0
        after = np.append(data[at + 1 : at + len(part) + 1], np.uint8(0))[: len(part)]
        whole = (after & 0xC0) != 0x80  # the next byte begins a character
        found.append(np.flatnonzero(whole & ((blank & low) | rare)) + at + 1)
    cuts = np.concatenate(found) if found else np.zeros(0, np.int64)
    if len(cuts):
        cuts = cuts[np.diff(cuts, prepend=-APART) >= APART]
    return cuts if len(cuts) and cuts[-1] == len(data) else np.append(cuts, len(data))


def chunk_rows(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, words, digest) of the chunks of one text."""
    data = np.frombuffer(raw, np.uint8)
    ends = cut_places(data)
    starts = np.concatenate(([0], ends[:-1]))
    blank = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    begins = ~blank
    begins[1:] &= blank[:-1]
    words = np.diff(np.concatenate(([0], np.cumsum(begins)))[np.concatenate((starts, ends[-1:]))])
    digest = xxhash.xxh3_64_intdigest
    spans = zip(starts.tolist(), ends.tolist(), strict=True)
    digests = np.fromiter((digest(raw[a:b]) for a, b in spans), np.uint64, len(ends)).view(np.int64)
    return starts, ends, words, digests


def run_rows(raw: bytes, least_words: int, least_bytes: int) -> tuple[np.ndarray, ...]:
    """(start, end, first word, last word, digest) of the shortest long enough runs.

    One begins at every chunk; where none of these ends, one ends.  The joint digest is a polynomial
    in the digests of the run's chunks, in their order.
    """
    starts, ends, words, digests = chunk_rows(raw)
    counted = np.concatenate(([0], np.cumsum(words)))
    by_words = np.searchsorted(counted, counted[:-1] + least_words)
    by_bytes = np.searchsorted(ends, starts + least_bytes) + 1
    after = np.minimum(by_words, by_bytes)
    begin = np.flatnonzero(after <= len(ends))
    after = after[begin]
    missed = np.setdiff1d(np.arange(1, len(ends) + 1), after)
    from_words = np.searchsorted(counted, counted[missed] - least_words, side="right")
    from_bytes = np.searchsorted(starts, ends[missed - 1] - least_bytes, side="right")
    back = np.maximum(from_words, from_bytes) - 1
    begin, after = np.concatenate((begin, back[back >= 0])), np.concatenate((after, missed[back >= 0]))
    powers = np.full(len(ends), PRIME, np.uint64)
    powers[:1] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    inverse = np.full(len(ends), pow(int(PRIME), -1, 1 << 64), np.uint64)
    inverse[:1] = 1
    inverse = np.cumprod(inverse, dtype=np.uint64)
    summed = np.concatenate((np.zeros(1, np.uint64), np.cumsum(digests.view(np.uint64) * powers, dtype=np.uint64)))
    joint = (summed[after] - summed[begin]) * inverse[begin]
    joint ^= joint >> np.uint64(32)
    return starts[begin], ends[after - 1], counted[begin], counted[after], (joint * PRIME).view(np.int64)


def run_table(docs: DataFrame, least_words: int, least_bytes: int) -> DataFrame:
    """``digest``, ``id``, ``start``, ``end`` (bytes), ``first``, ``last`` (words) of all runs of (id, text) rows."""
    names = ["digest", "id", "start", "end", "first", "last"]

    def run(batches):
        for batch in by_size(batches, 1, AT_ONCE):
            parts = []
            texts = batch.column(1).cast(pa.large_binary()).to_pylist()
            for name, raw in zip(batch.column(0).to_pylist(), texts, strict=True):
                if raw:
                    start, end, first, last, digest = run_rows(raw, least_words, least_bytes)
                    parts.append((digest, np.full(len(start), name, np.int64), start, end, first, last))
            if parts:
                columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
                kinds = [np.int64] * 2 + [np.int32] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(k)) for c, k in zip(columns, kinds, strict=True)], names=names)

    return docs.mapInArrow(run, "digest long, id long, start int, end int, first int, last int")


def _searchable(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.where("id is not null")
    seen = rows.groupBy("id").agg(F.min(F.xxhash64("text")).alias("low"), F.max(F.xxhash64("text")).alias("high"))
    unclear = stored(seen.where("low <> high").select("id"), "unclear")
    return rows.join(beside(unclear), "id", "left_anti")


def _with_holder(runs: DataFrame) -> DataFrame:
    """The runs whose digest occurs again, with ``kept_id``, the smallest id that has it.

    A digest with more than one in ``HOT`` of all runs is one of at most ``HOT``: these are broadcast, so that no
    task gets all runs of a passage that many documents share.
    """
    holders = runs.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("kept_id")).where("n > 1")
    holders = stored(holders, "holders")
    most = runs.count() // HOT
    hot = holders.where(F.col("n") > most).drop("n")
    met = runs.join(F.broadcast(hot), "digest")
    rest = runs.join(F.broadcast(hot.select("digest")), "digest", "left_anti").join(holders.where(F.col("n") <= most).drop("n"), "digest")
    return met.unionByName(rest)


def repeated_spans(
    docs: DataFrame, least_words: int = 20, id_col: str = "doc_id", text_col: str = "text", least_bytes: int = 400
) -> DataFrame:
    """The byte spans to remove: ``id``, ``start``, ``end``, ``n_words``, ``kept_ids`` (who keeps their runs)."""
    runs = stored(run_table(_searchable(docs, id_col, text_col), least_words, least_bytes), "runs")
    shared = stored(_with_holder(runs), "shared")
    # within its first document a run stays at its first place; what overlaps that place stays as far as it does
    own = shared.where("id = kept_id")
    place = own.groupBy("digest").agg(F.min("start").alias("kept_start"), F.min("first").alias("kept_first"))
    again = own.join(place, "digest").where("start > kept_start")
    again = again.withColumns(
        {
            "start": F.greatest(F.col("start"), F.col("kept_start") + F.col("end") - F.col("start")),
            "first": F.greatest(F.col("first"), F.col("kept_first") + F.col("last") - F.col("first")),
        }
    ).where("start < end")
    columns = ["id", "start", "end", "first", "last", "kept_id"]
    later = shared.where("id <> kept_id").select(columns).unionByName(again.select(columns)).distinct()
    ordered = Window.partitionBy("id").orderBy("start", "end")
    reached = F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(F.col("start") <= reached, 0).otherwise(1)
    spans = later.withColumn("begins", begins).withColumn("span", F.sum("begins").over(ordered))
    return (
        spans.groupBy("id", "span")
        .agg(
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            (F.max("last") - F.min("first")).cast("long").alias("n_words"),
            F.sort_array(F.collect_set("kept_id")).alias("kept_ids"),
        )
        .drop("span")
    )


def remove_spans(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the spans cut out of their texts; columns and rows stay as they are.

    ``spans`` is a stored table; while it is small the texts do not move.
    """
    key, added = unused(docs, "_key"), unused(docs, "_spans")
    pairs = F.sort_array(F.collect_list(F.struct("start", "end")))
    lists = spans.groupBy(F.col("id").alias(key)).agg(pairs.alias(added))
    at, names = docs.columns.index(text_col), docs.columns

    def run(batches):
        for batch in by_size(batches, at, AT_ONCE):
            texts = batch.column(at).cast(pa.large_binary()).to_pylist()
            out = []
            for raw, cuts in zip(texts, batch.column(len(names)).to_pylist(), strict=True):
                edges = [0, *(e for c in cuts for e in (c["start"], c["end"])), len(raw)]
                out.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            columns = [batch.column(i) for i in range(len(names))]
            columns[at] = pa.array(out, pa.large_binary()).cast(pa.large_string()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    lists = F.broadcast(lists) if spans.count() <= HELD else lists
    joined = docs.join(lists, docs[id_col].cast("long") == lists[key], "left").select(*[docs[c] for c in names], added)
    cut = joined.where(F.col(added).isNotNull()).mapInArrow(run, docs.schema)
    return joined.where(F.col(added).isNull()).drop(added).unionByName(cut)


def deduplicate(
    docs: DataFrame, least_words: int = 20, id_col: str = "doc_id", text_col: str = "text", least_bytes: int = 400
) -> DataFrame:
    """``docs`` without the passages that an earlier document, or an earlier place, already has."""
    spans = settled(docs.sparkSession, lambda: repeated_spans(docs, least_words, id_col, text_col, least_bytes), "spans")
    return remove_spans(docs, spans, id_col, text_col)
