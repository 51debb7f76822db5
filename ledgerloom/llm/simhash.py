"""SimHash near-duplicates: BK-trees over shards of fingerprints that share bit blocks.

A fingerprint of four-word shingles is taken of every whole text.  Equal fingerprints are
one node.  Fingerprints within ``radius`` bits agree on at least ``equal`` of ``radius + equal``
bit blocks, so every choice of ``equal`` blocks is a table, and a shard holds the nodes with
the same bits there: each linked pair meets in a shard, and no pair is lost.  A shard is
searched by a BK-tree (children keyed by their distance to the parent; a search follows the
edges whose key is within the radius of the distance found).  A large shard is cut into
parts, and each pair of parts is a tree and the queries against it, in a task of its own.
Tasks send spanning forests, never all pairs.

Nulls and edges: a null, empty or blank text has fingerprint zero and is linked like any
other.  Rows with one id are separate rows with the same component.  A null id is ignored by the
minimum, and a component of null ids alone has a null component id.  An empty table gives
an empty result.  Other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.common import Forest, beside, by_value, components, lower_words, row_hash, stored, task_count, unused
from ledgerloom.llm.words import by_size
from ledgerloom.session import settled

by_value(__name__)

BITS = 64
PART = 1024  # nodes of a shard that meet in one tree
AT_ONCE = 16 << 20  # bytes of text that leave Arrow together
BLOCK = 1 << 15  # shingles whose bits are counted at once


def fingerprint_of(text: str | bytes | None, words: int = 4, seed: int = 42) -> int:
    """The unsigned fingerprint of a whole text."""
    tokens = lower_words(text)
    if not tokens:
        return 0
    line = b" ".join(tokens)
    digest = xxhash.xxh64_intdigest
    if len(tokens) <= words:
        return digest(line, seed)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(tokens) - words + 1]
    spans = zip(starts.tolist(), ends[words - 1 :].tolist(), strict=True)
    hashes = np.fromiter((digest(line[a:b], seed) for a, b in spans), np.uint64, len(starts))
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), BLOCK):
        raw = hashes[at : at + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``mark`` (a hash of the text) and ``fp`` (the fingerprint's bits as a long) of every row."""

    def run(batches):
        for batch in by_size(batches, 1, AT_ONCE):
            texts = batch.column(1).cast(pa.large_binary()).to_pylist()
            found = np.array([fingerprint_of(t, words) for t in texts], np.uint64).view(np.int64)
            columns = [batch.column(0), batch.column(2), pa.array(found, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "mark", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.withColumn("mark", F.xxhash64("text")).mapInArrow(run, "id long, mark long, fp long")


def _blocks(count: int) -> list[tuple[int, int]]:
    """(shift, width) of ``count`` blocks that cover all bits."""
    edges = [BITS * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def shard_keys(fp: Column, radius: int, equal: int) -> Column:
    """An array of shard keys: the number of the table and the bits of its blocks."""
    keys = []
    for table, chosen in enumerate(combinations(_blocks(radius + equal), equal)):
        key = F.lit(table).cast("long")
        for shift, width in chosen:
            bits = F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
            key = F.shiftleft(key, width).bitwiseOR(bits)
        keys.append(key)
    return F.array(*keys)


class BKTree:
    """Children of a node are keyed by their integer distance to it."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        if self.values:
            at = 0
            while True:
                gap = (self.values[at] ^ value).bit_count()
                if (below := self.children[at].get(gap)) is None:
                    self.children[at][gap] = len(self.values)
                    break
                at = below
        self.values.append(value)
        self.children.append({})

    def within(self, value: int, radius: int) -> list[int]:
        found, stack = [], [0] if self.values else []
        while stack:
            at = stack.pop()
            gap = (self.values[at] ^ value).bit_count()
            if gap <= radius:
                found.append(self.values[at])
            if below := self.children[at]:
                if len(below) <= 2 * radius + 1:
                    stack += [x for key, x in below.items() if gap - radius <= key <= gap + radius]
                else:
                    stack += [below[key] for key in range(gap - radius, gap + radius + 1) if key in below]
        return found


def _forest_of(nodes: list[int], parts: list[int], tree_part: int, query_part: int, radius: int) -> list[tuple[int, int]]:
    mask = (1 << BITS) - 1
    forest, out, tree = Forest(), [], BKTree()
    inside = [n for n, p in zip(nodes, parts, strict=True) if p == tree_part]
    asked = [n for n, p in zip(nodes, parts, strict=True) if p == query_part]
    if tree_part != query_part:
        for n in inside:
            tree.add(n & mask)
    signed = lambda v: v - (1 << BITS) if v >> (BITS - 1) else v
    for n in asked:
        for other in tree.within(n & mask, radius):
            if (m := signed(other)) != n and forest.join(n, m):
                out.append((n, m))
        if tree_part == query_part:
            tree.add(n & mask)
    return out


def links(nodes: DataFrame, radius: int = 4, part: int = PART) -> DataFrame:
    """A spanning set of the links between distinct fingerprints ``fp``: pairs ``a``, ``b``."""
    count = nodes.count()
    # more equal blocks mean longer keys and more tables: keys about as long as log2 of the count
    equal = next((e for e in (2, 3, 4) if BITS * e // (radius + e) >= count.bit_length() - 1), 5)
    keyed = nodes.select("fp", F.explode(shard_keys(F.col("fp"), radius, equal)).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    dealt = keyed.join(sizes, "key").withColumn("parts", F.ceil(F.col("n") / part).cast("int"))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    groups = (
        pairs.groupBy(
            "key", F.least("part", "other").alias("tree"), F.greatest("part", "other").alias("query")
        )
        .agg(F.collect_list(F.struct("fp", "part")).alias("members"))
        .select("tree", "query", F.col("members.fp").alias("fps"), F.col("members.part").alias("parts"))
    )

    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                out += _forest_of(row["fps"], row["parts"], row["tree"], row["query"], radius)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"]
            )

    return groups.repartition(task_count(nodes)).mapInArrow(run, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, words: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text", part: int = PART
) -> DataFrame:
    """``id``, ``fp`` and ``component`` (smallest id reachable over links) of every row."""
    prints = stored(fingerprints(docs, words, id_col, text_col), "fingerprints")
    nodes = stored(prints.groupBy("fp").agg(F.min("id").alias("first")), "nodes")
    roots = components(links(nodes, radius, part))
    # the root of a component is its smallest fingerprint; its id is the smallest id below it
    grouped = roots.join(nodes, roots["node"] == nodes["fp"]).select("node", "root", "first")
    firsts = grouped.groupBy("root").agg(F.min("first").alias("component"))
    moved = stored(grouped.join(firsts, "root").select(F.col("node").alias("fp"), "component"), "components")
    ids = nodes.join(moved, "fp", "left").select("fp", F.coalesce("component", "first").alias("component"))
    return prints.join(ids, "fp").select("id", "fp", "component")


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _decisions(docs: DataFrame, words: int, radius: int, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``mark`` of the rows that go, and, with ``several``, of those of which one stays.

    A group is led by its smallest (id, fingerprint, mark); a null id comes last.
    """
    prints = stored(fingerprints(docs, words, id_col, text_col), "fingerprints")
    nodes = stored(prints.groupBy("fp").agg(F.count(F.lit(1)).alias("n")), "nodes")
    roots = components(links(nodes, radius))
    placed = nodes.join(roots, nodes["fp"] == roots["node"], "left").where("n > 1 or root is not null")
    placed = stored(placed.select("fp", F.coalesce("root", "fp").alias("root")), "groups")
    # all others are alone in their group: nothing is decided for them
    rows = stored(prints.join(placed, "fp"), "grouped")
    key = F.struct(F.col("id").isNull().alias("nameless"), "id", "fp", "mark")
    leaders = rows.groupBy("root").agg(F.min(key).alias("leader"))
    counted = rows.groupBy("root", "id", "mark").agg(F.count(F.lit(1)).alias("n")).join(leaders, "root")
    leads = F.col("id").eqNullSafe(F.col("leader.id")) & (F.col("mark") == F.col("leader.mark"))
    return counted.where(~leads | (F.col("n") > 1)).select("id", "mark", leads.alias("several"))


def keep_one(docs: DataFrame, words: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one document of each group: the one with the smallest id.

    Rows are told apart by id and text.  Of rows that share both one stays (the one whose other columns
    have the smallest hash); rows that share an id alone are decided each by its own group.  A row
    without an id stays only where its group has none with an id.
    """
    found = settled(docs.sparkSession, lambda: _decisions(docs, words, radius, id_col, text_col), "near-copies")
    key, mark, several = (unused(docs, n) for n in ("_key", "_mark", "_several"))
    table = beside(found.toDF(key, mark, several))
    same = docs[id_col].cast("long").eqNullSafe(table[key]) & (F.xxhash64(docs[text_col].cast("string")) == table[mark])
    joined = docs.join(table, same, "left")
    kept = joined.where(F.col(several).isNull()).select(*docs.columns)
    if found.where("several").isEmpty():
        return kept
    equal = Window.partitionBy(key, mark).orderBy(row_hash(docs))
    first = joined.where(F.col(several)).withColumn(several, F.row_number().over(equal)).where(F.col(several) == 1)
    return kept.unionByName(first.select(*docs.columns))
