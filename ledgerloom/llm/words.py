"""The words of a batch of texts as arrays: every distinct word once, texts as runs of codes."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ledgerloom.llm.common import by_value

by_value(__name__)


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a batch and the offsets of its texts; null is empty."""
    filled = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
    data = filled.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def give_back() -> None:
    """Return what is free to the system: workers stay between tasks, and an executor's memory is shared."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def by_size(batches: Iterable[pa.RecordBatch], column: int, most: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that a column's texts stay near ``most`` bytes; a longer text stands alone."""
    for batch in batches:
        give_back()
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            before = sizes[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(sizes, before + most, side="right")))
            yield batch.slice(at, end - at)
            at = end
        del batch
    give_back()


def is_blank(data: np.ndarray) -> np.ndarray:
    return (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))


@dataclass
class Words:
    first: np.ndarray  # the first word of each text, and the number of words
    codes: np.ndarray  # for every word its place among the distinct words
    data: np.ndarray  # the distinct words' bytes
    bounds: np.ndarray  # and their offsets

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def distinct(self) -> list[bytes]:
        raw, edges = self.data.tobytes(), self.bounds.tolist()
        return [raw[a:b] for a, b in zip(edges, edges[1:], strict=False)]

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sums over the texts of a value per word."""
        return np.diff(np.concatenate((np.zeros(1, values.dtype), np.cumsum(values)))[self.first])

    def per_word(self, flags: np.ndarray) -> np.ndarray:
        """Sums over the distinct words of a value per byte."""
        return np.diff(np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))[self.bounds])


def words_of(texts: pa.Array, lower: bool = False) -> Words:
    data, offsets = flat_bytes(texts)
    if lower:
        data = np.where((data >= 0x41) & (data <= 0x5A), data + np.uint8(32), data)
    blank = is_blank(data)
    begins = np.ones(len(data) + 1, bool)
    begins[1:-1] = blank[:-1]
    begins[offsets] = True
    starts = np.flatnonzero(begins[:-1] & ~blank)
    stops = np.ones(len(data) + 1, bool)
    stops[:-1] = blank
    stops[offsets] = True
    places = np.flatnonzero(stops)
    ends = places[np.searchsorted(places, starts, side="right")] if len(starts) else starts
    edges = np.empty(2 * len(starts) + 1, np.int64)
    edges[0:-1:2], edges[1::2], edges[-1] = starts, ends, len(data)
    spans = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(data))]
    )
    coded = spans.take(pa.array(np.arange(0, len(edges) - 1, 2))).dictionary_encode()
    found, bounds = flat_bytes(coded.dictionary)
    return Words(np.searchsorted(starts, offsets), coded.indices.to_numpy(), found, bounds)
