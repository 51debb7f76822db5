"""Nearest neighbours by inner product: an inverted file whose lists are scanned adaptively.

There are twice as many lists as the root of the number of vectors; their centroids are fitted by rounds of
distributed means over a sample that grows with them (``A_LIST`` vectors a list, or ``fit_rows``).  Every vector is
then put into its list.  How many lists a query probes follows from an audit: the exact neighbours of at most ``audit``
queries over all rows, and the smallest number of lists that leaves half of the allowed loss to the
tests below.  These queries are then searched like all others, and what loses more, lists or tests,
is widened until ``recall`` of their neighbours is found; only then are all queries searched.  A query
whose lists hold fewer than ``k`` other rows probes further ones.

Lists travel in bundles of bounded size.  A query's nearest lists, as many as hold more than ``k`` rows, are scored first and
whole; their k-th score is the query's first bound.  Its other lists follow in rounds of ``WIDER`` times as many rows, each
with the k-th score so far as its bound, so that few rows of a round reach it.  Their vectors are rotated at random and
scanned in column blocks.  With r the distance at which a candidate would just reach that bound, it is
abandoned as soon as its partial distance, scaled up to all dimensions, exceeds
``(1 + eps / sqrt(read)) * r``: a hypothesis test that is wrong only rarely.  What survives is scored on the original
vectors in double precision.

Nulls and edges: vectors that are null, zero, of another length than most, or hold null or
non-finite components take no part, nor do rows without an id; of rows that repeat an id one
takes part.  Equal scores are ordered by id.  With fewer candidates than ``k`` all are
returned; a single vector has none, and an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.common import by_value, stored
from ledgerloom.llm.vectors import matrix, rotation, sample, usable

by_value(__name__)

BLOCKS = 4  # column blocks of the rotated vectors
A_LIST = 32  # vectors a list in the sample that centroids are fitted on
MOST_LISTS = 65_536  # beyond that lists grow: all centroids go to every task
DRAWS = 1 << 30
WIDER = 8  # rows of a round of lists against those before it
AUDIT = 256
BUNDLE = 2048  # vectors whose lists travel together
PART = 4096  # vectors of a bundle in one task
ASKED = 4096  # queries of a bundle in one task


def fit_centroids(rows: DataFrame, total: int, lists: int, dims: int, fit_rows: int, rounds: int = 6) -> np.ndarray:
    """Centroids by rounds of means over about ``fit_rows`` of the rows; only centroids come to the driver.

    Entries are summed as whole numbers, so the order of the rows does not show.
    """
    drawn = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(DRAWS)) < int(DRAWS * min(1.0, fit_rows / total))
    fitted = rows if fit_rows >= total else stored(rows.where(drawn), "fitted")
    first = fitted if fit_rows >= total else fitted.unionByName(rows.orderBy("id").limit(1)).distinct()  # never none
    centroids = matrix(sample(first, lists, 11).column("v"), dims)
    for _ in range(rounds):
        centroids = _means(fitted, centroids, dims)
    return centroids


def _means(rows: DataFrame, centroids: np.ndarray, dims: int) -> np.ndarray:
    """The mean of the vectors nearest to each centroid; one that has none stays."""
    scale = 2.0 ** (36 - math.frexp(float(np.abs(centroids).max()))[1])
    most = 2.0**40  # 2^22 rows of a task stay below 2^63; entries 16 times the largest centroid's count as that

    def run(batches):
        sums, counts = {}, {}
        for batch in batches:
            vectors = matrix(batch.column(0), dims)
            own = nearest_lists(vectors, centroids, 1)[:, 0]
            whole = np.rint(np.clip(vectors * scale, -most, most)).astype(np.int64)
            order = np.argsort(own, kind="stable")
            heads, begins, sizes = np.unique(own[order], return_index=True, return_counts=True)
            for head, size, added in zip(heads.tolist(), sizes.tolist(), np.add.reduceat(whole[order], begins, axis=0), strict=True):
                sums[head] = sums[head] + added if head in sums else added
                counts[head] = counts.get(head, 0) + size
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([s.tolist() for s in sums.values()], pa.list_(pa.int64())), pa.array([counts[h] for h in sums], pa.int64())],
                names=["list", "sums", "n"],
            )

    parts = rows.select("v").mapInArrow(run, "list int, sums array<long>, n long")

    def merge(table: pa.Table) -> pa.Table:
        sums = np.array(table.column("sums").to_pylist(), object).sum(axis=0)  # whole numbers of any size
        n = sum(table.column("n").to_pylist())
        mean = [float(x) / n / scale for x in sums]
        return pa.table({"list": table.column("list").slice(0, 1), "mean": pa.array([mean], pa.list_(pa.float64()))})

    moved = centroids.copy()
    for row in parts.groupBy("list").applyInArrow(merge, "list int, mean array<double>").toArrow().to_pylist():
        moved[row["list"]] = row["mean"]
    return moved


def nearest_lists(vectors: np.ndarray, centroids: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` lists nearest to each vector, nearest first."""
    half = (centroids**2).sum(axis=1) / 2
    out = np.empty((len(vectors), count), np.int64)
    for at in range(0, len(vectors), 1024):
        near = vectors[at : at + 1024] @ centroids.T - half
        out[at : at + 1024] = np.argsort(-near, axis=1, kind="stable")[:, :count] if count > 1 else near.argmax(axis=1)[:, None]
    return out


def inner(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, each summed the same way wherever its row stands."""
    return (vectors * query).sum(axis=1)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: largest score first, then smallest id."""
    if len(ids) > 4 * k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= edge)
        return places[np.lexsort((ids[places], -scores[places]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def scan(turned: np.ndarray, norms: np.ndarray, query: np.ndarray, floor: float, places: np.ndarray, eps: float) -> np.ndarray:
    """The candidates (out of ``places``) that no test abandons; floor: the score to reach."""
    dims = turned.shape[1]
    reach = np.maximum((query @ query) + norms[places] - 2 * floor, 0.0)
    read, so_far = 0, np.zeros(len(places))
    for columns in np.array_split(np.arange(dims), min(BLOCKS, dims)):
        a, b = int(columns[0]), int(columns[-1]) + 1
        so_far = so_far + ((turned[places, a:b] - query[a:b]) ** 2).sum(axis=1)
        read = b
        slack = (1 + eps / math.sqrt(read)) if read < dims else 1 + 1e-9
        stays = so_far * (dims / read) <= slack**2 * reach + 1e-9
        places, so_far, reach = places[stays], so_far[stays], reach[stays]
    return places


def _kth(scores: np.ndarray, k: int) -> float:
    """The k-th largest score; without so many there is no bound."""
    return float(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else -math.inf


def exact_top(rows: DataFrame, asked: pa.Table, k: int, dims: int) -> DataFrame:
    """Brute force for a bounded set of queries over all rows: query, id, score."""
    names, wanted = asked.column("id").to_numpy(), matrix(asked.column("v"), dims)

    def run(batches):
        for batch in batches:
            ids, vectors = batch.column(0).to_numpy(), matrix(batch.column(1), dims)
            for name, query in zip(names.tolist(), wanted, strict=True):
                scores = inner(vectors, query)
                scores[ids == name] = -np.inf
                top = best(ids, scores, k)
                top = top[np.isfinite(scores[top])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(top), name)), pa.array(ids[top]), pa.array(scores[top])], names=["query", "id", "score"]
                )

    found = rows.mapInArrow(run, "query long, id long, score double")
    return _ranked(found, k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def held_by_lists(truth: pa.Table, asked: pa.Table, centroids: np.ndarray, dims: int) -> np.ndarray:
    """The share of the audited neighbours that the first 1, 2, ... lists of their queries hold."""
    if not truth.num_rows:
        return np.ones(len(centroids))
    order = nearest_lists(matrix(asked.column("v"), dims), centroids, len(centroids))
    place = {q: i for i, q in enumerate(asked.column("id").to_pylist())}
    own = nearest_lists(matrix(truth.column("v"), dims), centroids, 1)[:, 0]
    ranks = np.array([int(np.flatnonzero(order[place[q]] == l)[0]) for q, l in zip(truth.column("query").to_pylist(), own, strict=True)])
    return np.cumsum(np.bincount(ranks, minlength=len(centroids))) / len(ranks)


def _found_share(truth: pa.Table, found: DataFrame) -> float:
    """The share of the audited neighbours among what the search returned for the same queries."""
    wanted = set(zip(truth.column("query").to_pylist(), truth.column("id").to_pylist(), strict=True))
    got = {(r.query, r.id) for r in found.select("query", "id").collect()}  # audit * k rows
    return len(wanted & got) / len(wanted) if wanted else 1.0


def search(df: DataFrame, queries: DataFrame, k: int = 20, recall: float = 0.96, eps: float = 2.1, fit_rows: int | None = None,
           audit: int = AUDIT, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest rows of ``df`` for every row of ``queries``.

    A row with the query's own id is no candidate.
    """
    rows, dims, total = usable(df, id_col, vec_col)
    asked_rows, asked_dims, _ = usable(queries, id_col, vec_col)
    if not dims or asked_dims != dims:
        empty = df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
        return empty
    lists = max(1, min(MOST_LISTS, 2 * math.isqrt(total)))
    centroids = fit_centroids(rows, total, lists, dims, fit_rows or A_LIST * lists)
    bundles = -(-total // BUNDLE)
    turn = rotation(dims)

    def assign(batches):
        for batch in batches:
            own = nearest_lists(matrix(batch.column(1), dims), centroids, 1)[:, 0]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(own.astype(np.int32)), pa.array((own % bundles).astype(np.int32))],
                names=["id", "v", "list", "bundle"],
            )

    kind = rows.schema["v"].dataType.simpleString()
    placed = stored(rows.mapInArrow(assign, f"id long, v {kind}, list int, bundle int"), "lists")

    counted = placed.groupBy("list").count().collect()  # a row per list
    list_sizes = np.zeros(len(centroids), np.int64)
    list_sizes[[r["list"] for r in counted]] = [r["count"] for r in counted]
    bundled = _Bundled(placed, centroids, list_sizes, turn, k, bundles)
    unbounded = asked_rows.withColumn("floor", F.lit(-math.inf))
    leading = stored(_ranked(bundled.scan(unbounded, 1, 0.0, 0, k + 1), k), "leading")
    edges = [k + 1, WIDER * max(k + 1, total // len(centroids))]
    while edges[-1] < total:
        edges.append(WIDER * edges[-1])

    def scanned(asking: DataFrame, probes: int, eps: float) -> DataFrame:
        most = int(np.sort(list_sizes)[::-1][:probes].sum())  # rows that so many lists hold at most
        found = leading.join(asking.select(F.col("id").alias("query")), "query", "left_semi")
        for low, high in zip(edges, edges[1:], strict=False):
            if low > most:
                break
            bounds = found.where(F.col("rank") == k).select(F.col("query").alias("asked"), F.col("score").alias("floor"))
            bounded = asking.join(bounds, asking["id"] == bounds["asked"], "left").select(asking["id"], "v", F.coalesce("floor", F.lit(-math.inf)).alias("floor"))
            more = bundled.scan(bounded, probes, eps, low, high)
            found = stored(_ranked(found.drop("rank").unionByName(more), k), "round")
        return found

    audited = sample(asked_rows, audit, 2)
    truth = exact_top(rows, audited, k, dims).join(rows, "id").select("query", "id", "v").toArrow()  # audit * k rows
    trial = stored(asked_rows.where(F.col("id").isin(audited.column("id").to_pylist())), "trial")
    held = held_by_lists(truth, audited, centroids, dims)
    probes = min(len(centroids), int(np.searchsorted(held, (1 + recall) / 2)) + 1)
    # with all lists, and tests that cannot err, the search is exact
    while probes < len(centroids) or eps < math.sqrt(dims):
        share = _found_share(truth, scanned(trial, probes, eps))
        if share >= recall:
            break
        if probes < len(centroids) and (1 - held[probes - 1] >= held[probes - 1] - share or eps >= math.sqrt(dims)):
            probes = min(len(centroids), 2 * probes)
        else:
            eps = min(math.sqrt(dims), 2 * max(eps, 0.25))
    return scanned(asked_rows, probes, eps).select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")


class _Bundled:
    """Lists dealt into bundles, and the scan of the bundles that queries probe."""

    def __init__(self, placed: DataFrame, centroids: np.ndarray, list_sizes: np.ndarray, turn: np.ndarray, k: int, bundles: int) -> None:
        self.placed, self.centroids, self.list_sizes = placed, centroids, list_sizes
        self.turn, self.k, self.bundles = turn, k, bundles
        # large bundles are cut into parts
        self.sizes = stored(placed.groupBy("bundle").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts")), "bundles")

    def _probes(self, asking: DataFrame, probes: int, low: int, high: int) -> DataFrame:
        """(id, v, floor, bundle, lists) of a query's lists before which, nearest first, ``low`` to ``high`` - 1 rows lie."""
        centroids, list_sizes, bundles, k, dims = self.centroids, self.list_sizes, self.bundles, self.k, len(self.turn)
        kind = asking.schema["v"].dataType.simpleString()

        def order(vectors: np.ndarray) -> list[np.ndarray]:
            near = list(nearest_lists(vectors, centroids, probes))
            for i in [i for i, lists in enumerate(near) if list_sizes[lists].sum() <= k]:
                every = nearest_lists(vectors[i : i + 1], centroids, len(centroids))[0]
                near[i] = every[: max(probes, int(np.searchsorted(np.cumsum(list_sizes[every]), k + 1)) + 1)]
            return near

        def run(batches):
            for batch in batches:
                out = []
                for i, lists in enumerate(order(matrix(batch.column(1), dims))):
                    before = np.cumsum(list_sizes[lists]) - list_sizes[lists]
                    lists = lists[(before >= low) & (before < high)]
                    for bundle in np.unique(lists % bundles).tolist():
                        out.append((i, bundle, lists[lists % bundles == bundle].tolist()))
                pick = pa.array([x[0] for x in out], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).take(pick) for c in range(3)], pa.array([x[1] for x in out], pa.int32()), pa.array([x[2] for x in out], pa.list_(pa.int32()))],
                    names=["id", "v", "floor", "bundle", "lists"],
                )

        return asking.select("id", "v", "floor").mapInArrow(run, f"id long, v {kind}, floor double, bundle int, lists array<int>")

    def scan(self, asking: DataFrame, probes: int, eps: float, low: int, high: int) -> DataFrame:
        """query, id and score: of every part of a round's lists the k best that reach the query's bound."""
        turn, k, dims = self.turn, self.k, len(self.turn)
        wanted = stored(self._probes(asking, probes, low, high), "probes")
        # the queries of a bundle are cut into lots
        asks = wanted.groupBy("bundle").agg(F.ceil(F.count(F.lit(1)) / ASKED).cast("int").alias("lots"))
        sizes = stored(self.sizes.join(asks, "bundle"), "sizes")
        left = self.placed.join(sizes, "bundle").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
        left = left.withColumn("lot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lots").cast("long") - 1)))
        right = wanted.join(sizes, "bundle").withColumn("lot", F.pmod(F.xxhash64("id", F.lit(3)), F.col("lots")))
        right = right.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1)))

        def find(candidates: pa.Table, asking: pa.Table) -> pa.Table:
            ids, lists = candidates.column("id").to_numpy(), candidates.column("list").to_numpy()
            vectors = matrix(candidates.column("v"), dims)
            order = np.argsort(lists, kind="stable")
            ids, lists, vectors = ids[order], lists[order], vectors[order]
            turned, norms = vectors @ turn, (vectors**2).sum(axis=1)
            questions = matrix(asking.column("v"), dims)
            turned_questions = questions @ turn
            floors, out = asking.column("floor").to_numpy(), ([], [], [])
            for i, (name, chosen) in enumerate(zip(asking.column("id").to_pylist(), asking.column("lists").to_pylist(), strict=True)):
                begins, ends = np.searchsorted(lists, chosen), np.searchsorted(lists, chosen, side="right")
                places = np.concatenate([np.arange(a, b) for a, b in zip(begins, ends, strict=True)])
                places = places[ids[places] != name]
                if floors[i] > -math.inf:
                    places = scan(turned, norms, turned_questions[i], floors[i], places, eps)
                scores = inner(vectors[places], questions[i])
                places, scores = places[scores >= floors[i]], scores[scores >= floors[i]]
                top = best(ids[places], scores, k)
                out[0].append(np.full(len(top), name, np.int64))
                out[1].append(ids[places][top])
                out[2].append(scores[top])
            return pa.table([np.concatenate(x) if x else np.zeros(0) for x in out], names=["query", "id", "score"])

        keys = ["bundle", "part", "lot"]
        return (
            left.select(*keys, "id", "v", "list")
            .groupBy(*keys)
            .cogroup(right.select(*keys, "id", "v", "floor", "lists").groupBy(*keys))
            .applyInArrow(_when_both(find), "query long, id long, score double")
        )


def _when_both(find):
    def run(candidates: pa.Table, asking: pa.Table) -> pa.Table:
        if candidates.num_rows and asking.num_rows:
            return find(candidates, asking)
        kinds = pa.schema([("query", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])
        return kinds.empty_table()

    return run
