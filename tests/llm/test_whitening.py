"""Whitening against numpy and exact arithmetic."""

import math
from fractions import Fraction

import numpy as np
import pytest

from ledgerloom.llm import whitening
from ledgerloom.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def scaled(vectors):
    return [[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors]


def expected(vectors):
    """n, sums, exact deviations, eigenvalues and components by numpy, trace."""
    x = scaled(vectors)
    n, total = len(x), [sum(c) for c in zip(*x)]
    deviations = [sum((n * a - s) ** 2 for a, s in zip(row, total)) for row in x]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(row, total)] for row in x])
    v = centred.T @ centred / n
    values, vectors = np.linalg.eigh(v)
    return n, deviations, centred, values[::-1], vectors[:, ::-1], np.trace(v)


def check(rows, ids, vectors, most=8):
    n, deviations, centred, values, components, trace = expected(vectors)
    by = {}
    for r in rows:
        by.setdefault(r.component, []).append(r)
    assert sorted(by) == list(range(1, min(most, int((values > 1e-9 * values[0]).sum())) + 1))
    for k, own in by.items():
        found = {r.vec_id: r for r in own}
        assert len(own) == len(ids)
        white = np.array([found[i].whitened for i in ids])
        wanted = centred @ components[:, k - 1] / np.sqrt(values[k - 1])
        sign = np.sign(white @ wanted)
        assert np.allclose(sign * white, wanted, atol=1e-6)
        for i, d in zip(ids, deviations):
            assert found[i].deviation == d and found[i].n == n
            assert found[i].explained == pytest.approx(values[k - 1] / trace, rel=1e-9)
            assert 0 <= found[i].identity_error < 1e-9


def test_the_query(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    check(QUERIES["op12_whitening"](spark, sf_dir).collect(), [r.vec_id for r in given], [r.embedding for r in given])


def test_planted_directions(spark):
    """Some thousand rows over many partitions, of falling variance along known directions."""
    draw = np.random.default_rng(4)
    turned = np.linalg.qr(draw.normal(size=(12, 12)))[0]
    data = (draw.normal(size=(9000, 12)) * np.array([40, 30, 20, 15, 10, 8, 6, 5, 4, 3, 2, 1])) @ turned.T + 17.5
    data = data.astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(data)], SCHEMA).repartition(7)
    rows = whitening.whiten(df).withColumnRenamed("id", "vec_id").collect()
    check(rows, list(range(9000)), data)
    model = whitening.fit(*whitening.fit_rows(df))
    assert all(abs(model.components[:, k] @ turned[:, k]) > 0.99 for k in range(3))


def test_factor_and_rotations():
    draw = np.random.default_rng(5)
    half = draw.normal(size=(9, 5))
    v = half @ half.T
    factor = whitening.pivoted_cholesky(v)
    assert factor.shape == (9, 5) and np.allclose(factor @ factor.T, v)
    lowered = factor[np.argsort([np.flatnonzero(r).max(initial=-1) for r in factor], kind="stable")]
    assert (np.sort([(r == 0).sum() for r in factor])[-1]) == 4 and len(lowered) == 9  # the first pivot's row has one entry
    values, components = whitening.one_sided_jacobi(factor)
    assert np.allclose(values, np.linalg.eigvalsh(v)[::-1][:5]) and np.allclose(components.T @ components, np.eye(5))
    assert np.allclose(v @ components, components * values)


def test_edges(spark):
    usable = [[1.0, 2.0, 0.5], [1.0, 2.0, 0.5], [0.0, 0.0, 0.0], [3.0, -1.0, 0.25], [0.5, 0.5, 7.0]]
    odd = [None, [1.0, None, 2.0], [1.0, float("nan"), 2.0], [1.0, float("inf"), 2.0], [1.0, 2.0], []]
    ids = [1, 2, 3, 4, 5]
    data = [(i, v, 0) for i, v in zip(ids, usable)] + [(10 + i, v, 0) for i, v in enumerate(odd)]
    df = spark.createDataFrame(data, SCHEMA)
    widened = df.selectExpr("*", "'x' as id", "'x' as v", "'x' as component", "'x' as n")
    check(whitening.whiten(widened).withColumnRenamed("id", "vec_id").collect(), ids, usable)
    # rows that repeat an id, or have none, are rows of their own
    again = spark.createDataFrame([(1, v, 0) for v in usable[:3]] + [(None, v, 0) for v in usable[3:]], SCHEMA)
    rows = whitening.whiten(again).collect()
    assert len(rows) == 5 * 3 and {r.n for r in rows} == {5}
    # nothing varies, nothing is there, only one dimension varies
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 0)] * 3, SCHEMA)).collect() == []
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None, 0)], SCHEMA)).collect() == []
    line = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 3.0], 0)], SCHEMA)).collect()
    assert [(r.component, r.explained) for r in line] == [(1, 1.0), (1, 1.0)]
    assert sorted(abs(r.whitened) for r in line) == [1.0, 1.0]


def test_huge_entries_stay_exact(spark):
    vectors = [[2.0**33, 1.0], [2.0**33 + 2.0**12, 5.0], [2.0**33 - 2.0**12, -3.0]]
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], SCHEMA)
    model = whitening.fit(*whitening.fit_rows(df))
    assert model.total == [sum(c) for c in zip(*scaled(vectors))]
    assert [r.deviation for r in whitening.whiten(df).where("component = 1").orderBy("id").collect()] == expected(vectors)[1]
    beyond = spark.createDataFrame([(1, [3e38], 0), (2, [-3e38], 0)], SCHEMA)
    assert {r.deviation for r in whitening.whiten(beyond).collect()} == {None}
