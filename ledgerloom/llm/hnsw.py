"""Near-duplicate vectors: navigable small-world graphs per shard, queried by every vector.

Equal vectors are one node.  Nodes are dealt into shards; each shard builds a hierarchical graph
(every level holds a prefix of the shard's random order; links are chosen for diversity).  Every
node then searches every shard with a beam, candidates are verified by their cosine in double
precision, and tasks send spanning forests, of which the components are formed.  An audit compares
the links of bounded samples of nodes, found by brute force over all nodes, with the components:
one sample of the large components, and one of all other nodes that grows until enough of them have
links.  Every linked node counts alike.  While too few links are held together, beams are doubled and the
search repeated; where the audit meets too few linked nodes to judge by, until a doubled beam
finds nothing more.  The links
themselves are then counted among the members of each component, in bounded blocks.

Nulls and edges: vectors that are null, zero, of another length than most, or hold null or
non-finite components link with nothing and are components of their own.  A row without an id
has no links and a null component.  Of rows that repeat an id one vector takes part, and all get its
result.  An empty table gives an empty result.  Columns other than the two named are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import Forest, _state, by_value, components, stored
from ledgerloom.llm.vectors import matrix, sample, usable

by_value(__name__)

DEGREE = 16  # links of a node above the ground level; twice as many there
SHARDS = 8
SHARD_ROWS = 50_000  # more nodes make more shards
LOT_BYTES = 32 << 20  # of the vectors of the nodes that query a shard in one task
HELD_PLACES = 1 << 20  # of beams held at once: wider beams are searched for fewer nodes at a time
BUILD_BEAM = 48
WIDE = 4  # nodes a beam expands at once
CELLS = 1 << 24  # of the table of visited nodes
AUDIT = 256
LINKED = 64  # linked nodes outside the large components that an audit must meet
MOST = 8192  # nodes that an audit draws at most to meet them
LARGE = 64  # components that hold more than this part of the nodes are audited by themselves
MEMBERS = 2048  # of small components that share a block
GRID = 16  # a part of a large component holds so many times more, if its vectors stay within PART_BYTES
PART_BYTES = 32 << 20


def _unit(vectors: np.ndarray) -> np.ndarray:
    largest = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / largest  # so that squares neither vanish nor overflow
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def _diverse(vectors: np.ndarray, candidates: np.ndarray, near: np.ndarray, degree: int) -> np.ndarray:
    """Up to ``degree`` of each row's candidates (-1: none), best first.

    A candidate nearer to one already chosen than to the node itself is put off; places left over
    go to the nearest of those put off.
    """
    order = np.argsort(-near, axis=1, kind="stable")
    candidates, near = np.take_along_axis(candidates, order, 1), np.take_along_axis(near, order, 1)
    rows, width = candidates.shape
    chosen = np.full((rows, degree), -1, np.int64)
    count = np.zeros(rows, np.int64)
    taken = np.zeros((rows, width), bool)
    at = np.arange(rows)
    for j in range(width):
        mine = candidates[:, j]
        open_rows = at[(mine >= 0) & (count < degree)]
        if not len(open_rows):
            continue
        others = chosen[open_rows]
        close = np.einsum("rkd,rd->rk", vectors[others], vectors[mine[open_rows]])
        close[others < 0] = -np.inf
        good = open_rows[close.max(axis=1) < near[open_rows, j]]
        chosen[good, count[good]] = mine[good]
        count[good] += 1
        taken[good, j] = True
    for j in range(width):
        fill = at[~taken[:, j] & (candidates[:, j] >= 0) & (count < degree)]
        chosen[fill, count[fill]] = candidates[fill, j]
        count[fill] += 1
    return chosen


def beam_search(vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, starts: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, similarities) of every query's beam, -1 where it is not full; queries advance together.

    ``starts`` are entry nodes per query, -1 for none.
    """
    size, total = len(links), len(queries)
    nodes = np.full((total, beam), -1, np.int64)
    near = np.full((total, beam), -np.inf, np.float32)
    step = max(1, min(CELLS // max(size, 1), HELD_PLACES // beam))
    for lo in range(0, total, step):
        q = queries[lo : lo + step]
        rows = np.arange(len(q))
        seen = np.zeros((len(q), size + 1), bool)  # the last column stands for no node
        seen[:, size] = True
        begin = np.where(starts[lo : lo + step] >= 0, starts[lo : lo + step], size)
        ids, sims, done = np.full((len(q), beam), size), np.full((len(q), beam), -np.inf, np.float32), np.ones((len(q), beam), bool)
        fresh, active = begin, rows
        while True:
            # of a node offered twice in one step only the first counts
            ordered = np.sort(fresh, axis=1)
            ordered[:, 1:][ordered[:, 1:] == ordered[:, :-1]] = size
            new = np.where(seen[active[:, None], ordered], size, ordered)
            seen[active[:, None], new] = True
            got = np.einsum("rkd,rd->rk", vectors[np.minimum(new, size - 1)], q[active])
            got[new == size] = -np.inf
            all_ids = np.concatenate((ids[active], new), axis=1)
            all_sims = np.concatenate((sims[active], got), axis=1)
            all_done = np.concatenate((done[active], new == size), axis=1)
            top = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
            ids[active], sims[active] = np.take_along_axis(all_ids, top, 1), np.take_along_axis(all_sims, top, 1)
            done[active] = np.take_along_axis(all_done, top, 1)
            left = np.where(done[active], -np.inf, sims[active])
            wide = min(WIDE, beam)
            ahead = np.argpartition(-left, wide - 1, axis=1)[:, :wide]
            worth = np.take_along_axis(left, ahead, 1) > -np.inf
            done[active[:, None], ahead] = True
            current = np.where(worth, np.take_along_axis(ids[active], ahead, 1), size)
            going = worth.any(axis=1)
            active, current = active[going], current[going]
            if not len(active):
                break
            around = links[np.minimum(current, size - 1)]
            around = np.where((current[:, :, None] == size) | (around < 0), size, around)
            fresh = around.reshape(len(active), -1)
        nodes[lo : lo + step], near[lo : lo + step] = np.where(ids == size, -1, ids), sims
    return nodes, near


class Graph:
    """Levels of links over vectors in a random order; level l holds the first n / degree ** l."""

    def __init__(self, vectors: np.ndarray, levels: list[np.ndarray]) -> None:
        self.vectors, self.levels = vectors, levels

    @staticmethod
    def build(vectors: np.ndarray, beam: int = BUILD_BEAM) -> Graph:
        small = vectors.astype(np.float32)
        sizes = [len(small)]
        while sizes[-1] > DEGREE * DEGREE:
            sizes.append(sizes[-1] // DEGREE)
        graph = Graph(small, [])
        for level in range(len(sizes) - 1, -1, -1):
            graph.levels.insert(0, graph._link(sizes[level], DEGREE * (2 if level == 0 else 1), beam))
        return graph

    def _link(self, size: int, degree: int, beam: int) -> np.ndarray:
        """A level of the first ``size`` nodes, entered by way of the levels above."""
        links, done = np.full((size, degree), -1, np.int64), 0
        while done < size:
            end = min(size, done + max(64, min(512, done // 2)))
            own = np.arange(done, end)
            inside = (self.vectors[own] @ self.vectors[own].T).astype(np.float32)
            np.fill_diagonal(inside, -np.inf)
            peers, sims = np.broadcast_to(own, inside.shape), inside
            keep = min(beam, len(own))
            top = np.argpartition(-inside, keep - 1, axis=1)[:, :keep]
            peers, sims = np.take_along_axis(peers, top, 1), np.take_along_axis(sims, top, 1)
            peers = np.where(np.isfinite(sims), peers, -1)
            if done:
                entries = self.enter(self.vectors[own], done)
                found, near = beam_search(self.vectors, links[:done], self.vectors[own], entries, beam)
                peers, sims = np.concatenate((peers, found), axis=1), np.concatenate((sims, near), axis=1)
            chosen = _diverse(self.vectors, peers, sims, degree)
            links[own] = chosen
            self._link_back(links, own, chosen, degree)
            done = end
        return links

    def _link_back(self, links: np.ndarray, own: np.ndarray, chosen: np.ndarray, degree: int) -> None:
        node, place = np.nonzero(chosen >= 0)
        targets, sources = chosen[node, place], own[node]
        order = np.argsort(targets, kind="stable")
        targets, sources = targets[order], sources[order]
        heads, first, counts = np.unique(targets, return_index=True, return_counts=True)
        for lo in range(0, len(heads), 256):
            part = slice(lo, lo + 256)
            width = int(counts[part].max())
            grid = first[part][:, None] + np.arange(width)
            added = np.where(np.arange(width) < counts[part][:, None], sources[np.minimum(grid, len(sources) - 1)], -1)
            both = np.sort(np.concatenate((links[heads[part]], added), axis=1), axis=1)
            both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
            near = np.einsum("rkd,rd->rk", self.vectors[both], self.vectors[heads[part]])
            near[both < 0] = -np.inf
            links[heads[part]] = _diverse(self.vectors, both, near, degree)

    def enter(self, queries: np.ndarray, below: int | None = None) -> np.ndarray:
        """Entry nodes for the level under those that exist, among the first ``below`` nodes."""
        starts = np.zeros((len(queries), 1), np.int64)
        for links in reversed(self.levels):
            limit = len(links) if below is None else min(len(links), below)
            if limit <= 1:
                continue
            part = links[:limit]
            if limit < len(links):
                part = np.where(part < limit, part, -1)
            starts, _ = beam_search(self.vectors, part, queries, starts, 4)
        return starts

    def search(self, queries: np.ndarray, beam: int) -> np.ndarray:
        """The nodes of every query's beam on the ground level."""
        upper = Graph(self.vectors, self.levels[1:])
        return beam_search(self.vectors, self.levels[0], queries, upper.enter(queries), beam)[0]


def _build(table: pa.Table, dims: int) -> pa.Table:
    ids = table.column("id").to_numpy()
    order = np.random.default_rng(5).permutation(np.argsort(ids, kind="stable"))
    vectors = _unit(matrix(table.column("v"), dims)[order])
    graph = Graph.build(vectors)
    return pa.table(
        {
            "shard": table.column("shard").slice(0, 1),
            "ids": pa.array([ids[order].tobytes()], pa.binary()),
            "vectors": pa.array([vectors.tobytes()], pa.binary()),
            "links": pa.array([[x.astype(np.int32).tobytes() for x in graph.levels]], pa.list_(pa.binary())),
        }
    )


def _query(graphs: pa.Table, asking: pa.Table, dims: int, beam: int, least: float) -> pa.Table:
    """A spanning forest of the verified links between the asking nodes and the shard's."""
    row = graphs.to_pylist()[0]
    ids = np.frombuffer(row["ids"], np.int64)
    exact = np.frombuffer(row["vectors"], np.float64).reshape(len(ids), dims)
    sizes = [len(ids)]
    levels = []
    for i, raw in enumerate(row["links"]):
        levels.append(np.frombuffer(raw, np.int32).astype(np.int64).reshape(-1, DEGREE * (2 if i == 0 else 1)))
        sizes.append(len(levels[-1]))
    graph = Graph(exact.astype(np.float32), levels)
    names, wanted = asking.column("id").to_numpy(), _unit(matrix(asking.column("v"), dims))
    beam = min(beam, len(ids))
    step = max(1, HELD_PLACES // beam)
    forest, out = Forest(), []
    for lo in range(0, len(names), step):
        asked = wanted[lo : lo + step]
        found = graph.search(asked.astype(np.float32), beam)
        for column in range(found.shape[1]):
            place = found[:, column]
            cosine = np.where(place >= 0, (exact[place] * asked).sum(axis=1), -1.0)
            for i in np.flatnonzero(cosine >= least).tolist():
                a, b = int(names[lo + i]), int(ids[place[i]])
                if a != b and forest.join(a, b):
                    out.append((a, b))
    return pa.table({"a": pa.array([x[0] for x in out], pa.int64()), "b": pa.array([x[1] for x in out], pa.int64())})


def _shares(rows: DataFrame, audit: pa.Table, dims: int, least: float) -> list[float]:
    """For each audited node that has links the share of them whose other end is in its component."""
    names, wanted = audit.column("id").to_numpy(), _unit(matrix(audit.column("v"), dims))
    groups = audit.column("root").to_numpy()

    def run(batches):
        for batch in batches:
            ids, vectors = batch.column(0).to_numpy(), _unit(matrix(batch.column(1), dims))
            roots = batch.column(2).to_numpy()[:, None]
            for lo in range(0, len(names), AUDIT):
                part = slice(lo, lo + AUDIT)
                linked = (vectors @ wanted[part].T >= least) & (ids[:, None] != names[part])
                links, held = linked.sum(axis=0), (linked & (roots == groups[part])).sum(axis=0)
                some = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[part][some]), pa.array(links[some], pa.int64()), pa.array(held[some], pa.int64())], names=["id", "links", "held"]
                )

    found = rows.mapInArrow(run, "id long, links long, held long").groupBy("id").agg((F.sum("held") / F.sum("links")).alias("share"))
    return [r.share for r in found.collect()]  # at most the audited nodes


def _audit(nodes: DataFrame, roots: DataFrame, audit: int, dims: int, least: float, total: int) -> float:
    """The mean share of a linked node's true links that end in its own component; NaN without enough linked nodes.

    It is the smaller one of two means: over nodes of large components, and over all others.
    """
    sizes = roots.groupBy("root").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") * LARGE > total)
    large = [r.root for r in sizes.collect()]  # fewer than LARGE
    rows = nodes.join(roots, nodes["id"] == roots["node"], "left").select("id", "v", F.coalesce("root", "id").alias("root"))
    inside = F.col("root").isin(large) if large else F.lit(False)
    shares = _shares(rows, sample(rows.where(inside), audit, 6), dims, least) if large else []
    hot = sum(shares) / len(shares) if shares else 1.0
    bound = audit
    while True:
        drawn = sample(rows.where(~inside), bound, 6)
        shares = _shares(rows, drawn, dims, least) if drawn.num_rows else []
        complete = drawn.num_rows < bound  # all nodes outside the large components
        if complete or len(shares) >= LINKED or bound >= MOST:
            break
        bound = min(MOST, 4 * bound)
    found = min(hot, sum(shares) / len(shares) if shares else 1.0)
    if found == 1.0 and len(shares) < LINKED and not complete:
        return math.nan
    return found


def _linked(nodes: DataFrame, shards: int, lots: int, graphs: DataFrame, dims: int, beam: int, least: float) -> DataFrame:
    asking = nodes.select("id", "v", F.pmod(F.xxhash64("id", F.lit(9)), F.lit(lots)).cast("int").alias("lot"))
    asking = asking.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    held = graphs.withColumn("lot", F.explode(F.sequence(F.lit(0), F.lit(lots - 1))))

    def run(graph: pa.Table, asked: pa.Table) -> pa.Table:
        if graph.num_rows and asked.num_rows:
            return _query(graph, asked, dims, beam, least)
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})

    return held.groupBy("shard", "lot").cogroup(asking.groupBy("shard", "lot")).applyInArrow(run, "a long, b long")


def _counted(members: DataFrame, dims: int, least: float) -> DataFrame:
    """``id`` and ``links`` of all members (root, id, v, copies) of components.

    Small components share a block; a large one is cut into parts, and each pair of parts is a block that counts for
    both.  A component of n members moves them n / part times.
    """
    sizes = stored(members.groupBy("root").agg(F.count(F.lit(1)).alias("n")), "sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    bins = -(-total // MEMBERS)
    held = max(MEMBERS, min(GRID * MEMBERS, PART_BYTES // (8 * max(dims, 1))))
    is_small = F.col("n") <= MEMBERS // 2
    block = F.when(is_small, -1 - F.pmod(F.xxhash64("root"), F.lit(max(bins, 1)))).otherwise(F.col("root"))
    parts = F.when(is_small, 1).otherwise(F.ceil(F.col("n") / held)).cast("int")
    dealt = members.join(sizes, "root").withColumn("block", block).withColumn("small", is_small).withColumn("parts", parts)
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("id", F.lit(2)), F.col("parts")).cast("int"))
    same = [F.col(c).alias(c) for c in ("block", "small", "root", "id", "v", "copies")]
    left = dealt.select(F.col("part").alias("p"), F.explode(F.sequence("part", F.col("parts") - 1)).alias("q"), *same)
    # a part meets itself on the left alone
    right = dealt.where("part > 0").select(F.explode(F.sequence(F.lit(0), F.col("part") - 1)).alias("p"), F.col("part").alias("q"), *same)
    kinds = pa.schema([("id", pa.int64()), ("links", pa.int64())])

    def run(key: tuple, mine: pa.Table, others: pa.Table) -> pa.Table:
        alone = key[2].as_py() == key[3].as_py()
        others = mine if alone else others
        if not mine.num_rows or not others.num_rows:
            return kinds.empty_table()
        ids, names = mine.column("id").to_numpy(), others.column("id").to_numpy()
        roots, groups = mine.column("root").to_numpy(), others.column("root").to_numpy()
        copies, theirs = mine.column("copies").to_numpy(), others.column("copies").to_numpy()
        vectors = _unit(matrix(mine.column("v"), dims))
        wanted = vectors if alone else _unit(matrix(others.column("v"), dims))
        counts, back = np.zeros(len(ids), np.int64), np.zeros(len(names), np.int64)
        for at in range(0, len(ids), 256):
            rows = slice(at, at + 256)
            linked = (vectors[rows] @ wanted.T >= least) & (roots[rows, None] == groups) & (ids[rows, None] != names)
            counts[rows] = linked @ theirs
            if not alone:
                back += copies[rows] @ linked
        if not alone:
            ids, counts = np.concatenate((ids, names)), np.concatenate((counts, back))
        return pa.table({"id": pa.array(ids), "links": pa.array(counts)}, schema=kinds)

    keys = ["block", "small", "p", "q"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, "id long, links long")
    return found.groupBy("id").agg(F.sum("links").alias("links"))


def near_duplicates(df: DataFrame, least: float = 0.9, recall: float = 0.995, beam: int = 32, shards: int = SHARDS, audit: int = AUDIT,
                    id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """id, n_links, component_id and kept of every row of ``df``."""
    rows, dims, _ = usable(df, id_col, vec_col)
    everyone = df.select(F.col(id_col).cast("long").alias("id"))
    nodes = stored(rows.groupBy("v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies")), "nodes")
    total = nodes.count()
    if not total:
        return everyone.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.col("id").isNotNull().alias("kept"))
    shards = max(shards, -(-total // SHARD_ROWS))
    lots = -(-total * 8 * dims // LOT_BYTES)
    dealt = nodes.select("id", "v", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"))
    graphs = stored(
        dealt.groupBy("shard").applyInArrow(
            lambda table: _build(table, dims), "shard int, ids binary, vectors binary, links array<binary>"
        ),
        "graphs",
    )
    state = None
    while True:
        roots = stored(components(_linked(nodes, shards, lots, graphs, dims, beam, least)), "roots")
        if beam >= total:
            break
        share = _audit(nodes, roots, audit, dims, least, total)
        before, state = state, _state(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))) if math.isnan(share) else None
        if share >= recall or (state is not None and state == before):
            break
        beam *= 2
    members = nodes.join(roots, nodes["id"] == roots["node"]).select("root", "id", "v", "copies")
    counts = stored(_counted(stored(members, "members"), dims, least), "counts")
    copied = nodes.where("copies > 1").select("v", F.col("id").alias("first"))
    named = rows.join(copied, "v", "left").select("id", F.coalesce("first", "id").alias("node_id"))
    sizes = nodes.select(F.col("id").alias("node_id"), "copies")
    found = (
        named.join(sizes, "node_id")
        .join(counts.select(F.col("id").alias("node_id"), "links"), "node_id", "left")
        .join(roots.select(F.col("node").alias("node_id"), "root"), "node_id", "left")
        .select("id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node_id").alias("component_id"))
    )
    return (
        everyone.join(found, "id", "left")
        .select("id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)))
    )
