"""Benchmark decontamination: exact runs and proximity matches against brute force and SQL."""

import hashlib
import random
import re
from itertools import product

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import phrases
from ledgerloom.llm.queries import ORACLES, QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def brute(docs, items, size):
    """Per row of ``docs``: id, n_words, n_hit, sorted ids of the items."""
    out = []
    for doc_id, text in docs:
        own, hit, named = words(text), set(), set()
        for item_id, other in items:
            wanted = words(other)
            n = min(size, len(wanted))
            for at in range(len(wanted) - n + 1 if n else 0):
                for place in range(len(own) - n + 1):
                    if own[place : place + n] == wanted[at : at + n]:
                        hit |= set(range(place, place + n))
                        named |= {str(item_id)} - {"None"}
        out.append((doc_id, len(own), len(hit), sorted(named)))
    return sorted(out, key=str)


@pytest.fixture()
def items(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string")


def found(docs, items, size):
    rows = phrases.contamination(docs, items, size).collect()
    return sorted([(r.id, r.n_words, r.n_hit, list(r.item_ids)) for r in rows], key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(docs, items, seed):
    draw = random.Random(seed)
    some = lambda low, high: " ".join(draw.choices(["a", "B", "c", "dé"], k=draw.randint(low, high)))
    texts = [(i, some(0, 40)) for i in range(40)]
    tests = [(i, some(0, 9)) for i in range(12)] + [(0, "a b c"), (90, None), (91, "...")]
    assert found(docs(texts), items(tests), 4) == brute(texts, tests, 4)


def test_edges(docs, items, clashing):
    passage = " ".join(f"w{i}" for i in range(12))
    texts = [
        (1, None), (2, ""), (3, "  ... "), (4, passage), (4, passage), (4, "other words, " + passage.upper()),
        (None, passage), (5, "x " * 20_000 + passage), (6, passage[:-4]), (7, "Straße ŒUVRE 9 straße"), (8, "the " * 500),
    ]
    tests = [(10, passage), (11, passage), (9, passage + " more"), (None, "Œuvre 9"), (12, "the the the"), (12, "strasse"), (13, None), (14, "ŒUVRE")]
    rows = found(clashing(docs(texts)), clashing(items(tests)), 10)
    assert rows == brute(texts, tests, 10)
    by_id = {r[0]: r for r in rows}
    assert by_id[5][2:] == (12, ["10", "11", "9"]) and by_id[8][2:] == (500, ["12"])
    assert by_id[7][2:] == (2, ["14"])  # only A-Z are lowered, and the item without an id is not named
    assert found(docs([]), items(tests), 10) == []
    assert found(docs(texts[:4]), items([]), 10) == brute(texts[:4], [], 10)


def test_one_text_that_most_rows_repeat(docs, items):
    passage = " ".join(f"w{i}" for i in range(11))
    texts = [(1, passage)] * 300 + [(i, f"unlike {i}") for i in range(2, 50)]
    rows = found(docs(texts), items([(1, passage)]), 10)
    assert rows == brute(texts, [(1, passage)], 10)


def test_no_window_meets_every_document(spark, docs, items):
    """Frequent words alone make no candidates: seeds are the rarest two of a window."""
    texts = [(i, "the of and in " * 50 + f"rare{i} the of and") for i in range(100)]
    test = items([(1, "and in the of and in rare7 the of and")])
    terms = phrases.vocabulary(phrases.item_words(test)[0])
    index = phrases.postings(docs(texts), terms)
    windows = phrases.item_windows(phrases.item_words(test)[0], terms, index, 10)
    assert phrases._at_seeds(index, phrases.seeds(windows)).count() == 1


def test_proximity(docs, items):
    texts = [
        (1, "one two three"), (2, "three x one x two"), (3, "three x x x x one two"), (4, "one one two"), (5, None),
        (6, "two x one three one two"), (None, "Three two one"), (7, "four"),
    ]
    tests = [(1, "one two three"), (2, "four"), (3, "absent four")]
    rows = phrases.near_matches(docs(texts), items(tests), size=3, span=5).collect()
    assert sorted([(r.doc_id, r.item_id, r.window, r.start) for r in rows], key=str) == sorted(
        [(1, "1", 0, 0), (2, "1", 0, 0), (6, "1", 0, 0), (None, "1", 0, 0), (7, "2", 0, 0)], key=str
    )


def test_proximity_against_brute_force(docs, items):
    draw = random.Random(5)
    texts = [(i, " ".join(draw.choices("abcdefgh", k=30))) for i in range(30)]
    tests = [(i, " ".join(draw.choices("abcdefgh", k=6))) for i in range(5)]
    expected = set()
    for (i, text), (j, test) in product(texts, tests):
        own, wanted = text.split(), test.split()
        for at in range(3):
            need = set(wanted[at : at + 4])
            starts = [s for s in range(len(own)) if need <= set(own[s : s + 6])]
            if starts:
                # the first start at which a word of the window stands
                s = next(s for s in range(starts[0], len(own)) if own[s] in need and need <= set(own[s : s + 6]))
                expected.add((i, str(j), at, s))
    rows = phrases.near_matches(docs(texts), items(tests), size=4, span=6).collect()
    assert {(r.doc_id, r.item_id, r.window, r.start) for r in rows} == expected and expected


def test_the_query_and_its_sql(spark, sf_dir):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    df = QUERIES["op11_phrases"](spark, sf_dir)
    cursor = con.execute(ORACLES["op11_phrases"])
    names = [c[0] for c in cursor.description]
    expected = sorted(tuple(r[names.index(c)] for c in df.columns) for r in cursor.fetchall())
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == expected and any(r[-1] for r in rows)
    clean = next(r for r in rows if not r[-1])
    assert clean[4] == hashlib.sha256(b"").hexdigest()


def test_no_python_in_the_plan(spark, docs, items):
    df = phrases.contamination(docs([(1, "a b")]), items([(1, "a")]), 10)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert df.where(F.col("n_hit") > 0).count() == 1
