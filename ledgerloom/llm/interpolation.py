"""Language-model scores by deleted interpolation.

The model mixes maximum-likelihood estimates of all orders up to ``order``:
``P_k(w | h) = L * c(h w) / c(h) + (1 - L) * P_{k-1}``, down to the uniform ``1 / (V + 1)``, with a weight
``L`` for every order and frequency bucket of the context (powers of two).  The weights are learned
by expectation-maximisation on held-out counts: one part of the training documents is deleted from the
counts and predicted by the rest.  Final scores use the counts of all training documents.

Documents are dealt into splits of bounded size; their texts travel compressed.  A split sends its distinct n-grams, as sorted
64-bit hashes in packed columns, to key buckets; there they are summed over all splits, and
the sums go back in the order in which the keys came, so that they need no keys.  Work and memory of a
task follow the split or bucket, and a frequent n-gram is one entry per split.  Only the EM's weights
(at most 64 an order) and two totals reach the driver.

Nulls and edges: a null or empty text is its end token alone.  Rows that repeat an id are learned from and scored
one by one.  A row without an id is never held out.  Without training documents all counts are 0, the
vocabulary is empty and every token has probability 1.  An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import by_value, stored, word_count
from ledgerloom.llm.words import Words, by_size, flat_bytes, words_of

by_value(__name__)

SPLIT_BYTES = 6 << 20  # of text that a task counts and scores together
LEVELS = 64  # frequency buckets of contexts
END = xxhash.xxh3_64_intdigest(b" end")  # no word holds a blank
ROUNDS = 40
EVEN = 1e-4


def mixed(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The key of a context followed by a word."""
    x = context * np.uint64(0x9E3779B97F4A7C15) + word
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Tokens:
    """The tokens of several texts, one after another: words, then an end."""

    first: np.ndarray  # the first token of each text, and the number of tokens
    keys: list[np.ndarray]  # per order the key of every token's n-gram

    @staticmethod
    def of(texts: pa.Array, order: int) -> Tokens:
        words: Words = words_of(texts, lower=True)
        digest = xxhash.xxh3_64_intdigest
        hashes = np.fromiter((digest(w) for w in words.distinct()), np.uint64)
        first = words.first + np.arange(len(words.first))
        total = int(first[-1])
        ends = first[1:] - 1
        inside = np.ones(total, bool)
        inside[ends] = False
        flat = np.full(total, END, np.uint64)
        if len(words.codes):
            flat[inside] = hashes[words.codes]
            begins = np.zeros(total, bool)
        begins[first[:-1]] = True
        keys = [flat]
        for k in range(2, order + 1):
            context = np.concatenate((keys[-1][:1], keys[-1][:-1]))
            context[begins] = np.uint64((END + k) % (1 << 64))
            keys.append(mixed(context, flat))
        return Tokens(first, keys)

    def begins(self) -> np.ndarray:
        flags = np.zeros(int(self.first[-1]), bool)
        flags[self.first[:-1]] = True
        return flags


def pack(values: np.ndarray) -> bytes:
    """Whole numbers as byte planes of the smallest width, which compress well when alike."""
    top = int(values.max()) if len(values) else 0
    width = next(w for w in (1, 2, 4, 8) if top < 1 << 8 * w)
    raw = values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T
    return bytes([width]) + raw.tobytes()


def unpack(raw: bytes) -> np.ndarray:
    width = raw[0]
    planes = np.frombuffer(raw, np.uint8, offset=1).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").reshape(-1)


def dealt(rows: DataFrame) -> DataFrame:
    """(id, text, role, split) rows as one row per batch and split, the texts run together and compressed."""

    def run(batches):
        for batch in by_size(batches, 1, 2 * SPLIT_BYTES):
            split = batch.column(3).to_numpy()
            order = np.argsort(split, kind="stable")
            data, offsets = flat_bytes(batch.column(1).take(pa.array(order)))
            ids, roles = batch.column(0).take(pa.array(order)), batch.column(2).to_numpy()[order].astype(np.int8)
            cuts = [0, *(np.flatnonzero(np.diff(split[order])) + 1).tolist(), len(order)]
            spans = list(zip(cuts, cuts[1:], strict=False)) if len(order) else []
            columns = [
                pa.array([int(split[order[a]]) for a, _ in spans], pa.int32()),
                pa.array([ids[a:b].to_pylist() for a, b in spans], pa.list_(pa.int64())),
                pa.array([roles[a:b].tobytes() for a, b in spans], pa.binary()),
                pa.array([np.diff(offsets[a : b + 1]) for a, b in spans], pa.list_(pa.int64())),
                pa.array([zlib.compress(data[offsets[a] : offsets[b]], 1) for a, b in spans], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["split", "ids", "roles", "sizes", "texts"])

    ordered = rows.select("id", "text", "role", "split")
    return ordered.mapInArrow(run, "split int, ids array<long>, roles binary, sizes array<long>, texts binary")


def opened(table: pa.Table) -> tuple[pa.Array, np.ndarray, pa.Array]:
    """The ids, roles and texts that ``dealt`` put into a split."""
    sizes = table.column("sizes").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    data = b"".join(map(zlib.decompress, table.column("texts").to_pylist()))
    texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    roles = np.frombuffer(b"".join(table.column("roles").to_pylist()), np.int8)
    return table.column("ids").combine_chunks().flatten(), roles, texts


def _edges(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each key bucket (the upper bits) begins in sorted keys, and the end."""
    heads = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.concatenate(([0], np.searchsorted(keys, heads), [len(keys)]))


def _count(table: pa.Table, order: int, bits: int) -> Iterator[tuple]:
    """(order, bucket, keys, counts in training, counts in the deleted part) of a split."""
    _, roles, texts = opened(table)
    tokens = Tokens.of(texts, order)
    role = np.repeat(roles, np.diff(tokens.first))
    for k, flat in enumerate(tokens.keys, 1):
        keys, place = np.unique(flat, return_inverse=True)
        training = np.bincount(place[role > 0], minlength=len(keys))
        deleted = np.bincount(place[role == 2], minlength=len(keys))
        edges = _edges(keys, bits)
        for b, (lo, hi) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
            if hi > lo:
                yield k, b, pack(keys[lo:hi]), pack(training[lo:hi]), pack(deleted[lo:hi])


def _merge(table: pa.Table, apart: int) -> pa.Table:
    """Sums over all splits of a bucket's keys, sent back in the order they came.

    Only the splits of the deleted part, ``apart`` and above, need its own counts.
    """
    parts = [unpack(x).astype(np.uint64) for x in table.column("keys").to_pylist()]
    keys, place = np.unique(np.concatenate(parts), return_inverse=True)
    sums = [
        np.bincount(place, np.concatenate([unpack(x) for x in table.column(name).to_pylist()]).astype(np.float64), len(keys)).astype(np.int64)
        for name in ("training", "deleted")
    ]
    cuts = np.cumsum([len(p) for p in parts])[:-1]
    back = [[pack(x) for x in np.split(s[place], cuts)] for s in sums]
    back[1] = [x if split >= apart else None for x, split in zip(back[1], table.column("split").to_pylist(), strict=True)]
    once = np.zeros((2, len(parts)), np.int64)  # the bucket's totals stand in one row
    once[:, 0] = (sums[0] > 0).sum(), sums[0].sum()
    same = {c: table.column(c) for c in ("order", "bucket", "split")}
    return pa.table(same | {"training": pa.array(back[0], pa.binary()), "deleted": pa.array(back[1], pa.binary()), "n_distinct": once[0], "n_total": once[1]})


def _token_counts(tokens: Tokens, counts: pa.Table, name: str) -> list[np.ndarray]:
    """Per order the count of every token's n-gram, out of the sums of its split."""
    rows = sorted(zip(counts.column("order").to_pylist(), counts.column("bucket").to_pylist(), counts.column(name).to_pylist(), strict=True))
    out = []
    for k, flat in enumerate(tokens.keys, 1):
        _, place = np.unique(flat, return_inverse=True)
        sums = np.concatenate([unpack(raw).astype(np.int64) for o, _, raw in rows if o == k])
        out.append(sums[place])
    return out


def _estimates(tokens: Tokens, counts: list[np.ndarray], total: int, texts: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per order the n-gram's count and its context's count, for every token."""
    contexts = [np.full(len(counts[0]), total)]
    begins = tokens.begins()
    for lower in counts[:-1]:
        context = np.concatenate((lower[:1], lower[:-1]))
        context[begins] = texts  # how many texts begin
        contexts.append(context)
    return counts, contexts


def level_of(count: np.ndarray) -> np.ndarray:
    """The frequency bucket: 0 for 0, else one more than the logarithm to base two."""
    return np.frexp(count.astype(np.float64))[1]


def probability(counts: list[np.ndarray], contexts: list[np.ndarray], weights: list[list[float]], vocabulary: int) -> np.ndarray:
    found = np.full(len(counts[0]), 1 / (vocabulary + 1))
    for c, h, w in zip(counts, contexts, weights, strict=True):
        share = np.array(w)[level_of(h)] * (h > 0)
        found = share * c / np.maximum(h, 1) + (1 - share) * found
    return found


def _held_out(table: pa.Table, counts: pa.Table, order: int, totals: tuple[int, int]) -> pa.Table:
    """Distinct tuples of counts of the deleted tokens as the other training documents have them."""
    tokens = Tokens.of(opened(table)[2], order)
    training, deleted = (_token_counts(tokens, counts, name) for name in ("training", "deleted"))
    kept, contexts = _estimates(tokens, [t - d for t, d in zip(training, deleted, strict=True)], *totals)
    rows, n = np.unique(np.stack([x for pair in zip(kept, contexts, strict=True) for x in pair], axis=1), axis=0, return_counts=True)
    named = {f"{x}{k}": rows[:, 2 * (k - 1) + i].copy() for k in range(1, order + 1) for i, x in enumerate("ch")}
    return pa.table(named | {"n": n})


def learn_weights(held: DataFrame, order: int, vocabulary: int) -> list[list[float]]:
    """EM over the held-out tuples (c1, h1, .., n): per order and context bucket the share of the estimate."""
    weights = [[0.5] * LEVELS for _ in range(order)]
    level = lambda h: F.when(h > 0, F.floor(F.log2(h.cast("double"))) + 1).otherwise(0).cast("int")
    tuples = held.select(
        "n", *[F.when(F.col(f"h{k}") > 0, F.col(f"c{k}") / F.col(f"h{k}")).otherwise(0.0).alias(f"p{k}") for k in range(1, order + 1)],
        *[level(F.col(f"h{k}")).alias(f"b{k}") for k in range(1, order + 1)],
    )
    tuples = stored(tuples.groupBy(*[c for c in tuples.columns if c != "n"]).agg(F.sum("n").alias("n")), "held-out")
    for _ in range(ROUNDS):
        below, mixes, shares = F.lit(1 / (vocabulary + 1)), [], []
        for k in range(1, order + 1):
            share = F.when(F.col(f"b{k}") > 0, F.get(F.array(*[F.lit(w) for w in weights[k - 1]]), F.col(f"b{k}"))).otherwise(0.0)
            shares.append(share * F.col(f"p{k}"))
            below = shares[-1] + (1 - share) * below
            mixes.append(below)
        reach, sums = F.col("n").cast("double"), []
        for k in range(order, 0, -1):
            stop = reach * shares[k - 1] / mixes[k - 1]
            sums += [F.sum(stop).alias(f"stop{k}"), F.sum(reach).alias(f"reach{k}")]
            reach = reach - stop
        found = tuples.groupBy(*[f"b{k}" for k in range(1, order + 1)]).agg(*sums).collect()  # at most 64 ** (order - 1) rows
        moved = 0.0
        for k in range(1, order + 1):
            for b in range(1, LEVELS):
                rows = [r for r in found if r[f"b{k}"] == b]
                reached = sum(r[f"reach{k}"] for r in rows)
                if reached > 0:
                    new = min(max(sum(r[f"stop{k}"] for r in rows) / reached, 0.0), 1 - 1e-6)
                    moved = max(moved, abs(new - weights[k - 1][b]) * min(1.0, reached / 1000))
                    weights[k - 1][b] = new
        if moved < EVEN:
            break
    return weights


def _score(table: pa.Table, counts: pa.Table, order: int, totals: tuple[int, int], vocabulary: int, weights: list[list[float]]) -> pa.Table:
    ids, roles, texts = opened(table)
    tokens = Tokens.of(texts, order)
    kept, contexts = _estimates(tokens, _token_counts(tokens, counts, "training"), *totals)
    per = lambda values: np.add.reduceat(values, tokens.first[:-1])  # noqa: E731  every text has its end
    base = np.log10((kept[0] + 1) / (totals[0] + vocabulary + 1))
    score = np.log10(probability(kept, contexts, weights, vocabulary))
    return pa.table(
        {
            "doc_id": ids,
            "held_out": pa.array(roles == 0),
            "n_tokens": np.diff(tokens.first).astype(np.int64),
            "n_known": per((kept[0] > 0).astype(np.int64)),
            "base_score": per(base),
            "score": per(score),
        }
    )


def score_documents(docs: DataFrame, held_out: Column, deleted: Column, order: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    ``held_out`` marks the rows not learned from, ``deleted`` those of the others on which the weights are learned.
    """
    role = F.when(F.coalesce(held_out, F.lit(False)), 0).when(F.coalesce(deleted, F.lit(False)), 2).otherwise(1)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), role.alias("role"))
    sizes = rows.groupBy("role").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text") + 1).alias("size")).collect()
    volume = {r.role: r.size for r in sizes}
    texts = {r.role: r.n for r in sizes}
    splits = -(-sum(volume.values()) // SPLIT_BYTES) or 1
    apart = -(-volume.get(2, 0) // SPLIT_BYTES)  # the deleted part has splits of its own
    bits = max(1, (2 * splits - 1).bit_length())
    draw = F.xxhash64("id", "text")
    others = max(1, splits - apart)
    split = F.when(F.col("role") == 2, others + F.pmod(draw, F.lit(max(1, apart)))).otherwise(F.pmod(draw, F.lit(others)))
    rows = rows.withColumn("split", split.cast("int"))

    def count(key: tuple, table: pa.Table) -> pa.Table:
        found = list(_count(table, order, bits))
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        columns = [pa.array([x[i] for x in found], kind) for i, kind in enumerate(kinds)]
        return pa.table([*columns, pa.array([key[0].as_py()] * len(found), pa.int32())], names=["order", "bucket", "keys", "training", "deleted", "split"])

    sent = dealt(rows).groupBy("split").applyInArrow(count, "order int, bucket int, keys binary, training binary, deleted binary, split int")
    sums = sent.groupBy("order", "bucket").applyInArrow(
        lambda table: _merge(table, others), "order int, bucket int, split int, training binary, deleted binary, n_distinct long, n_total long"
    )
    sums = stored(sums, "counts")
    whole = sums.where("order = 1").agg(F.sum("n_distinct").alias("v"), F.sum("n_total").alias("n")).first()
    vocabulary, total = whole.v or 0, whole.n or 0
    counts = sums.select("split", "order", "bucket", "training", "deleted")

    learned = [[0.5] * LEVELS for _ in range(order)]
    if texts.get(2):
        part = rows.where("role = 2")
        size = (total - _tokens_of(part), texts.get(1, 0))
        names = ", ".join(f"c{k} long, h{k} long" for k in range(1, order + 1)) + ", n long"

        def hold(key: tuple, table: pa.Table, found: pa.Table) -> pa.Table:
            if table.num_rows:
                return _held_out(table, found, order, size)
            return pa.table({c.split()[0]: pa.array([], pa.int64()) for c in names.split(", ")})

        own = counts.where(F.col("split") >= others)
        held = dealt(part).groupBy("split").cogroup(own.groupBy("split")).applyInArrow(hold, names)
        learned = learn_weights(stored(held, "tuples"), order, vocabulary)

    totals = (total, texts.get(1, 0) + texts.get(2, 0))

    def score(key: tuple, table: pa.Table, found: pa.Table) -> pa.Table:
        return _score(table, found, order, totals, vocabulary, learned)

    scored = (
        dealt(rows).groupBy("split")
        .cogroup(counts.drop("deleted").groupBy("split"))
        .applyInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    )
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def _tokens_of(rows: DataFrame) -> int:
    return rows.agg(F.sum(word_count(F.col("text")) + 1)).first()[0] or 0


def id_remainder(id_col: str = "doc_id", modulus: int = 7) -> Column:
    return F.crc32(F.col(id_col).cast("string")) % modulus
