"""Every registered query against its SQL on the given tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from bindings.queries import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def oracle(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    yield con
    con.close()


def _shown(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value + 0.0:.6f}"
    return str(value)


def _sorted(rows):
    return sorted(tuple(_shown(v) for v in row) for row in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= entry.queries().items()
    assert ORACLES.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    cursor = oracle.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    expected = _sorted([row[i] for i in places] for row in cursor.fetchall())
    found = _sorted(df.select(*columns).collect())
    assert found == expected
    assert found, "an empty result proves nothing"


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "rank" and df.count() > 0
