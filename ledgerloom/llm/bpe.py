"""Token ids of whole texts by a public byte-level BPE vocabulary, a batch at a time.

The vocabulary's own split never crosses the place where a blank follows a non-blank, so
a text is cut there, every distinct cut of a batch is encoded once, and the ids
of the texts are put together from those by position.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from ledgerloom.llm.common import by_value
from ledgerloom.llm.words import flat_bytes, is_blank

by_value(__name__)

DEFAULT_FILE = "byte_bpe_50k.json"
AT_ONCE = 20_000  # distinct cuts per call of the encoder


def vocabulary_path(name: str = DEFAULT_FILE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def _can_cut(path: str) -> bool:
    """Whether no added token holds a blank or takes blanks around it, which a cut would divide."""
    added = tokenizer(path).get_added_tokens_decoder().values()
    return not any(t.lstrip or t.rstrip or any(c.isspace() for c in t.content) for t in added)


def _cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sorted places to cut at: text ends, and blanks after a byte that is surely no blank."""
    blank = is_blank(data)
    at = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
    # U+0085, U+00A0 and the three-byte blanks end in these; a cut is left out when in doubt
    last, second = data[at - 1], data[np.maximum(at - 2, 0)]
    third = data[np.maximum(at - 3, 0)]
    doubt = (last >= 0x80) & ((second == 0xC2) | ((third >= 0xE1) & (third <= 0xE3)))
    chosen = np.zeros(len(data) + 1, bool)
    chosen[at[~doubt]] = True
    chosen[offsets] = True
    return np.flatnonzero(chosen)


@lru_cache(maxsize=2)
def _byte_lengths(path: str) -> np.ndarray:
    """Bytes of every token: the vocabulary writes one character per byte, but added tokens as they are."""
    vocabulary = tokenizer(path).get_vocab(with_added_tokens=False)
    added = tokenizer(path).get_added_tokens_decoder()
    lengths = np.zeros(max(max(vocabulary.values()), *added) + 1 if added else max(vocabulary.values()) + 1, np.int64)
    for token, number in vocabulary.items():
        lengths[number] = len(token)
    for number, token in added.items():
        lengths[number] = len(token.content.encode())
    return lengths


def _ends_blank(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Whether the last character of each piece between ``bounds`` is a blank of any kind."""
    at = bounds[1:] - 1
    last, second, third = data[at], data[np.maximum(at - 1, 0)], data[np.maximum(at - 2, 0)]
    found = is_blank(last) | ((last >= 0x1C) & (last <= 0x1F))
    doubt = (last >= 0x80) & ((second == 0xC2) | ((third >= 0xE1) & (third <= 0xE3)))
    for i in np.flatnonzero(doubt).tolist():
        found[i] = data[bounds[i] : bounds[i + 1]].tobytes().decode()[-1].isspace()
    return found


def _encode_distinct(words: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all distinct cuts, one after another, and the number of ids of each.

    Cuts that begin with a blank and end with none keep their ids when they are run together, so
    they are encoded as long lines; the ids' byte lengths tell them apart again.
    """
    encoder, size = tokenizer(path), _byte_lengths(path)
    data, offsets = flat_bytes(words)
    data = np.ascontiguousarray(data)
    ids, counts = [], []
    for at in range(0, len(words), AT_ONCE):
        bounds = offsets[at : at + AT_ONCE + 1].astype(np.int64)
        alone = ~is_blank(data[bounds[:-1]]) | _ends_blank(data, bounds)
        # neighbours lie side by side: a line is all from one beginning to the next
        begins = alone.copy()
        begins[1:] |= alone[:-1]
        begins[0] = True
        edges = np.append(bounds[:-1][begins], bounds[-1])
        lines = pa.LargeStringArray.from_buffers(len(edges) - 1, pa.py_buffer(edges), pa.py_buffer(data)).to_pylist()
        found = [np.array(e.ids, np.uint32) for e in encoder.encode_batch_fast(lines, add_special_tokens=False)]
        flat = np.concatenate(found)
        ends = np.searchsorted(np.cumsum(size[flat]), bounds[1:] - bounds[0]) + 1
        ids.append(flat)
        counts.append(np.diff(ends, prepend=0))
    return np.concatenate(ids), np.concatenate(counts)


def encode_batch(texts: pa.Array, path: str) -> Iterator[np.ndarray]:
    """The ids of every text, in order."""
    data, offsets = flat_bytes(texts)
    if not len(data):
        yield from (np.zeros(0, np.uint32) for _ in range(len(texts)))
        return
    if not _can_cut(path):
        for text in texts.to_pylist():
            yield np.array(tokenizer(path).encode(text or "", add_special_tokens=False).ids, np.uint32)
        return
    cuts = _cuts(data, offsets)
    pieces = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    )
    coded = pieces.dictionary_encode()
    flat, lengths = _encode_distinct(coded.dictionary, path)
    starts = np.cumsum(lengths) - lengths
    codes = coded.indices.to_numpy()
    first = np.searchsorted(cuts, offsets)  # the piece that each text begins with
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        own = codes[a:b]
        n = lengths[own]
        total = int(n.sum())
        ends = np.cumsum(n)
        yield flat[np.repeat(starts[own] - ends + n, n) + np.arange(total)]
