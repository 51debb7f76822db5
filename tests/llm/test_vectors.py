"""Operators on vectors: nearest neighbours and near-duplicates."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import ann, hnsw
from ledgerloom.llm.common import components
from ledgerloom.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<float>, label int"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], VECTORS)


ODD = [
    (1, None), (2, []), (3, [0, 0, 0]), (4, [1, None, 0]), (5, [math.nan, 1, 0]), (6, [math.inf, 0, 0]), (7, [1, 2]),
    (None, [1, 0, 0]), (20, [1, 0, 0]), (20, [1, 0, 0]), (21, [2, 0, 0]), (22, [1, 0, 0]), (40, [0, 1, 0]), (41, [1e-30, 1e-30, 0]),
]
USABLE = {20, 21, 22, 40, 41}


def brute_search(rows, k):
    usable = {i: np.float32(v).astype(np.float64) for i, v in rows}
    out = {}
    for q in usable:
        if q % 20 == 0:
            scores = sorted((-float((usable[q] * v).sum()), i) for i, v in usable.items() if i != q)
            out[q] = [(i, -s) for s, i in scores[:k]]
    return out


def test_search_of_the_embeddings(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    truth = brute_search([(r.vec_id, r.embedding) for r in rows], 20)
    found = {}
    for r in QUERIES["op9_adaptive_scan"](spark, sf_dir).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(found[r.query_id])
    assert set(found) == set(truth)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in truth[q]}) for q in truth)
    assert hits / sum(map(len, truth.values())) >= 0.95
    for q in truth:
        assert len(found[q]) == len(truth[q])
        assert found[q] == sorted(found[q], key=lambda x: (-x[1], x[0]))


def test_lists_and_tests_keep_recall_without_help_of_the_sample(spark):
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(1500, 24))
    vectors[:500] = vectors[0] + 1e-3 * rng.normal(size=(500, 24))  # a hot list
    rows = [(i, v) for i, v in enumerate(vectors)]
    truth = brute_search(rows, 5)
    frame = table(spark, rows)
    found = ann.search(frame, frame.where("vec_id % 20 = 0"), k=5, fit_rows=64, audit=32).collect()
    got = {(r.query_id, r.vec_id) for r in found}
    assert sum((q, i) in got for q in truth for i, _ in truth[q]) / (5 * len(truth)) >= 0.9


def found_share(found, truth):
    got = {(r.query_id, r.vec_id) for r in found}
    return sum((q, i) in got for q in truth for i, _ in truth[q]) / sum(map(len, truth.values()))


def test_search_of_the_embeddings_with_a_small_sample(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    truth = brute_search([(r.vec_id, r.embedding) for r in frame.collect()], 20)
    found = ann.search(frame, frame.where("vec_id % 20 = 0"), k=20, fit_rows=50).collect()
    assert found_share(found, truth) >= 0.95
    assert len(found) == sum(map(len, truth.values()))


def test_tests_that_err_too_often_are_widened(spark):
    rng = np.random.default_rng(12)
    rows = list(enumerate(rng.normal(size=(1200, 24))))
    truth = brute_search(rows, 5)
    frame = table(spark, rows)
    found = ann.search(frame, frame.where("vec_id % 20 = 0"), k=5, eps=0.01, fit_rows=300).collect()
    assert found_share(found, truth) >= 0.96  # all queries are audited
    assert len(found) == 5 * len(truth)


def test_results_come_from_the_probed_lists_not_from_the_sample(spark, monkeypatch):
    rng = np.random.default_rng(13)
    rows = list(enumerate(rng.normal(size=(400, 16))))
    monkeypatch.setattr(ann, "scan", lambda turned, norms, query, floor, places, eps: places[:0])
    monkeypatch.setattr(ann, "_found_share", lambda *_: 1.0, raising=False)
    truth = brute_search(rows, 5)
    frame = table(spark, rows)
    found = ann.search(frame, frame.where("vec_id % 20 = 0"), k=5).collect()  # the sample is the table
    assert len(found) == 5 * len(truth) and found_share(found, truth) < 0.9


def test_scan_abandons_nothing_that_reaches_the_floor_when_certain():
    rng = np.random.default_rng(1)
    vectors, query = rng.normal(size=(300, 16)), rng.normal(size=16)
    scores = ann.inner(vectors, query)
    floor = np.sort(scores)[-10]
    kept = ann.scan(vectors, (vectors**2).sum(axis=1), query, floor, np.arange(300), eps=50.0)
    assert set(np.flatnonzero(scores >= floor)) <= set(kept.tolist())
    few = ann.scan(vectors, (vectors**2).sum(axis=1), query, floor, np.arange(300), eps=0.5)
    assert len(few) < 300


def test_search_edges(spark):
    frame = table(spark, ODD).withColumn("v", F.lit("x")).withColumn("id", F.lit(1))
    found = ann.search(frame, frame.where("vec_id % 20 = 0"), k=20).orderBy("query_id", "rank").collect()
    by_query = {}
    for r in found:
        by_query.setdefault(r.query_id, []).append(r.vec_id)
    assert by_query == {20: [21, 22, 41, 40], 40: [41, 20, 21, 22]}
    assert ann.search(frame.limit(0), frame.limit(0)).count() == 0
    one = table(spark, [(20, [1, 0])])
    assert ann.search(one, one).count() == 0


def brute_links(rows, least=0.9):
    names = [i for i, _ in rows]
    vectors = np.float32([v for _, v in rows]).astype(np.float64)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    linked = unit @ unit.T >= least
    np.fill_diagonal(linked, False)
    root = {n: n for n in names}
    moved = True
    while moved:
        moved = False
        for a, n in enumerate(names):
            low = min([root[n], *(root[names[b]] for b in np.flatnonzero(linked[a]))])
            moved |= low != root[n]
            root[n] = low
    return {n: (int(linked[a].sum()), root[n]) for a, n in enumerate(names)}


@pytest.mark.parametrize("members", [hnsw.MEMBERS, 16])
def test_near_duplicates_against_brute_force(spark, monkeypatch, members):
    monkeypatch.setattr(hnsw, "MEMBERS", members)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    rows = [(i, rng.normal(size=16)) for i in range(400)]
    rows += [(400 + i, centres[i % 12] + 0.05 * rng.normal(size=16)) for i in range(200)]
    rows += [(600 + i, centres[0]) for i in range(80)]  # equal vectors
    found = {r.id: (r.n_links, r.component_id) for r in hnsw.near_duplicates(table(spark, rows)).collect()}
    assert found == brute_links(rows)


def test_links_within_a_component_of_many_parts(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "MEMBERS", 16)
    monkeypatch.setattr(hnsw, "GRID", 2)
    rng = np.random.default_rng(21)
    centre = rng.normal(size=12)
    rows = [(i, centre + 0.22 * rng.normal(size=12)) for i in range(220)] + [(300 + i, centre) for i in range(5)]
    found = {r.id: (r.n_links, r.component_id) for r in hnsw.near_duplicates(table(spark, rows)).collect()}
    assert found == brute_links(rows)


def test_centroids_do_not_depend_on_the_order_of_rows(spark):
    rng = np.random.default_rng(22)
    rows = [(i, rng.normal(size=6)) for i in range(300)]
    frames = [table(spark, rows).select(F.col("vec_id").alias("id"), F.col("embedding").alias("v")).repartition(n) for n in (2, 5)]
    first, second = (ann.fit_centroids(f, 300, 8, 6, 300, rounds=3) for f in frames)
    assert first.shape == (8, 6) and (first == second).all()


def test_embeddings_against_brute_force(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    found = {r.vec_id: (r.n_links, r.component_id) for r in QUERIES["op5_hnsw"](spark, sf_dir).collect()}
    assert found == brute_links(rows)


def test_graph_search_finds_neighbours():
    rng = np.random.default_rng(4)
    vectors = hnsw._unit(rng.normal(size=(1500, 16)))
    graph = hnsw.Graph.build(vectors)
    assert len(graph.levels) == 2 and [len(x) for x in graph.levels] == [1500, 93]
    queries = hnsw._unit(rng.normal(size=(100, 16)))
    found = graph.search(queries.astype(np.float32), 48)
    truth = np.argsort(-(queries @ vectors.T), axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b)) for a, b in zip(found.tolist(), truth.tolist())]) > 9.3


def test_beams_widen_until_the_audit_passes(spark, monkeypatch):
    beams = []
    real = hnsw._linked
    monkeypatch.setattr(hnsw, "_linked", lambda *a: beams.append(a[-2]) or real(*a))
    verdicts = iter([0.5, 0.9, 1.0])
    monkeypatch.setattr(hnsw, "_audit", lambda *_: next(verdicts))
    rng = np.random.default_rng(5)
    hnsw.near_duplicates(table(spark, [(i, rng.normal(size=8)) for i in range(300)]), beam=8).count()
    assert beams == [8, 16, 32]


@pytest.fixture()
def losing(monkeypatch):
    """The first beam loses all links but those between nodes below the given id."""

    def lose(below):
        real, beams = hnsw._linked, []

        def linked(*args):
            beams.append(args[-2])
            edges = real(*args)
            return edges.where(F.greatest("a", "b") < below) if len(beams) == 1 else edges

        monkeypatch.setattr(hnsw, "_linked", linked)
        return beams

    return lose


def pairs_and_others(rng, first, pairs, others, dims):
    centres = rng.normal(size=(pairs, dims))
    rows = [(first + i, centres[i // 2] + 0.01 * rng.normal(size=dims)) for i in range(2 * pairs)]
    return rows + [(first + 2 * pairs + i, rng.normal(size=dims)) for i in range(others)]


def test_a_dense_group_does_not_hide_lost_pairs(spark, losing):
    rng = np.random.default_rng(21)
    centre = rng.normal(size=32)
    rows = [(i, centre + 0.05 * rng.normal(size=32)) for i in range(300)]
    rows += pairs_and_others(rng, 300, 60, 480, 32)
    beams = losing(300)
    found = {r.id: (r.n_links, r.component_id) for r in hnsw.near_duplicates(table(spark, rows)).collect()}
    assert found == brute_links(rows) and len(beams) > 1


def test_few_lost_pairs_are_met_by_the_audit(spark, losing):
    rows = pairs_and_others(np.random.default_rng(22), 0, 3, 700, 32)
    beams = losing(0)
    found = {r.id: (r.n_links, r.component_id) for r in hnsw.near_duplicates(table(spark, rows), audit=16).collect()}
    assert found == brute_links(rows) and len(beams) > 1


def test_without_enough_linked_nodes_a_wider_beam_must_find_nothing_more(spark, losing, monkeypatch):
    monkeypatch.setattr(hnsw, "MOST", 16, raising=False)
    rows = pairs_and_others(np.random.default_rng(23), 0, 3, 700, 32)
    beams = losing(0)
    found = {r.id: (r.n_links, r.component_id) for r in hnsw.near_duplicates(table(spark, rows), audit=16).collect()}
    assert found == brute_links(rows) and beams == [32, 64, 128]


def test_near_duplicate_edges(spark):
    frame = table(spark, ODD).withColumn("v", F.lit("x")).withColumn("id", F.lit(1))
    rows = hnsw.near_duplicates(frame).collect()
    assert len(rows) == len(ODD)
    got = {r.id: (r.n_links, r.component_id, r.kept) for r in rows}
    assert got[20] == (2, 20, True) and got[21] == got[22] == (2, 20, False)
    assert all(got[i] == (0, i, True) for i in (1, 2, 3, 4, 5, 6, 7, 40, 41))
    assert got[None] == (0, None, False)
    assert hnsw.near_duplicates(frame.limit(0)).count() == 0


def test_components_of_long_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    edges = spark.createDataFrame([*path, *star, (5000, 5000)], "a long, b long")
    roots = {r.node: r.root for r in components(edges).collect()}
    assert roots == {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(300)}
