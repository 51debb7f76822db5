"""Word-piece counts by a linear longest-match automaton, without building the pieces.

The vocabulary is a trie over bytes.  Pieces that begin a word carry a marker, all others
continue one; the lone marker is a piece too, after which a word goes on with continuing ones.  A state of the trie that cannot go on pops the longest pieces of what it has read and
fails over to the state of the rest; how many pieces it pops is computed beforehand,
so a word is read once, byte by byte, and only numbers are added up.  In a task the automaton
steps through all distinct words of a batch at once, until only the few longest are left; these it reads one by one.

Nulls and edges: a null, empty or blank text has no words and no pieces.  A word that the vocabulary
cannot cover (none, where it has the lone marker and all single bytes) counts as one piece, the unknown one.  Repeated rows and ids are counted
row by row, a null id stays null, other columns are not read, and an empty table gives an empty result.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.bpe import DEFAULT_FILE, vocabulary_path
from ledgerloom.llm.common import by_value
from ledgerloom.llm.words import by_size, words_of

by_value(__name__)

AT_ONCE = 16 << 20  # bytes of text whose words are counted together
NARROW = 32  # so few words are read one by one; side by side each byte costs a round of numpy calls
NONE = -1  # no state, or no way to cut what was read into pieces


def byte_alphabet() -> dict[str, int]:
    """How byte-level vocabularies write a byte as one visible character."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def read_vocabulary(path: str) -> tuple[list[bytes], list[bytes]]:
    """Pieces that begin a word (written with a blank before them, which may stand alone) and pieces that continue one."""
    with open(path, encoding="utf-8") as file:
        tokens = json.load(file)["model"]["vocab"]
    alphabet = byte_alphabet()
    pieces = [bytes(alphabet[c] for c in t) for t in tokens if all(c in alphabet for c in t)]
    return [p[1:] for p in pieces if p[:1] == b" "], [p for p in pieces if p[:1] != b" "]


@dataclass
class Automaton:
    """Trie edges as sorted ``state * 256 + byte`` keys, and per state where failing leads."""

    keys: np.ndarray
    targets: np.ndarray
    fail: np.ndarray  # state of what is left after popping, or NONE
    pops: np.ndarray  # pieces popped on the way there
    end_pops: np.ndarray  # pieces if the word ends here, or NONE
    inner: int  # root of the pieces that continue a word

    def step(self, states: np.ndarray, values: np.ndarray) -> np.ndarray:
        wanted = states * 256 + values
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.targets[at], NONE)

    @cached_property
    def edges(self) -> dict[int, int]:
        return dict(zip(self.keys.tolist(), self.targets.tolist(), strict=True))

    @cached_property
    def failing(self) -> list[tuple[int, int]]:
        return list(zip(self.fail.tolist(), self.pops.tolist(), strict=True))

    def read(self, state: int, data: bytes) -> tuple[int, int]:
        """The state after ``data`` and the pieces popped on the way, byte by byte."""
        edges, failing, popped = self.edges, self.failing, 0
        for value in data:
            while (after := edges.get(state * 256 + value)) is None:
                state, more = failing[state]
                popped += more
                if state == NONE:
                    return NONE, popped
            state = after
        return state, popped


def build(begins: list[bytes], continues: list[bytes]) -> Automaton:
    children: list[dict[int, int]] = [{}, {}]
    parent, byte, piece = [NONE, NONE], [0, 0], [False, False]
    for root, pieces in ((0, begins), (1, continues)):
        for text in pieces:
            at = root
            for b in text:
                if b not in children[at]:
                    children[at][b] = len(children)
                    children.append({})
                    parent.append(at)
                    byte.append(b)
                    piece.append(False)
                at = children[at][b]
            piece[at] = at > 1
    size = len(children)
    fail, pops = [NONE] * size, [0] * size
    if b"" in begins:  # the marker alone is popped, and the word goes on as a continued one
        fail[0], pops[0] = 1, 1
    order = [0, 1]
    for at in order:  # breadth first: a state's failure needs shorter states only
        order += children[at].values()
    for at in order[2:]:
        if piece[at]:
            fail[at], pops[at] = 1, 1
            continue
        state, popped = fail[parent[at]], pops[parent[at]]
        while state != NONE and byte[at] not in children[state]:
            popped += pops[state]
            state = fail[state]
        if state != NONE:
            fail[at], pops[at] = children[state][byte[at]], popped
    ends = [NONE] * size
    ends[1] = 0
    for at in order[2:]:
        state, popped = at, 0
        while state not in (1, NONE):
            popped += pops[state]
            state = fail[state]
        ends[at] = popped if state == 1 else NONE
    pairs = sorted((s * 256 + b, t) for s, below in enumerate(children) for b, t in below.items())
    keys, targets = np.array(pairs, np.int64).reshape(-1, 2).T
    return Automaton(keys.copy(), targets.copy(), np.array(fail), np.array(pops), np.array(ends), 1)


@lru_cache(maxsize=2)
def automaton(path: str) -> Automaton:
    return build(*read_vocabulary(path))


def count_words(machine: Automaton, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Pieces of every word ``data[start:end]``; the words are read side by side."""
    order = np.argsort(starts - ends, kind="stable")  # longest first: the words still read are a prefix
    begin, lengths = starts[order], (ends - starts)[order]
    states, counts = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
    alive = len(order)
    for place in range(int(lengths[0]) if len(lengths) else 0):
        alive = int(np.searchsorted(-lengths[:alive], -place, side="left"))
        if alive <= NARROW:  # the longest words: one may be as long as its text
            for word in np.flatnonzero(states[:alive] != NONE):
                rest = data[begin[word] + place : begin[word] + lengths[word]].tobytes()
                states[word], popped = machine.read(int(states[word]), rest)
                counts[word] += popped
            break
        values = data[begin[:alive] + place].astype(np.int64)
        active = np.flatnonzero(states[:alive] != NONE)
        while len(active):
            now = states[active]
            after = machine.step(now, values[active])
            stuck = after == NONE
            states[active[~stuck]] = after[~stuck]
            active, now = active[stuck], now[stuck]
            counts[active] += machine.pops[now]
            states[active] = machine.fail[now]
            active = active[machine.fail[now] != NONE]
    known = states != NONE
    last = np.where(known, machine.end_pops[states], NONE)
    total = np.where(last == NONE, 1, counts + last)
    out = np.empty(len(order), np.int64)
    out[order] = np.where(lengths == 0, 0, total)
    return out


def _count_batch(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    words = words_of(texts)
    found = count_words(automaton(path), words.data, words.bounds[:-1], words.bounds[1:])
    return words.counts, words.per_text(found[words.codes])


def count_tokens(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_words`` and ``n_tokens`` (word pieces) of every whole text."""
    path = path or vocabulary_path(DEFAULT_FILE)

    def run(batches):
        for batch in by_size(batches, 1, AT_ONCE):
            words, tokens = _count_batch(batch.column(1), path)
            columns = [batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_tokens long")
