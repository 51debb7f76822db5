"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest

from ledgerloom.llm import spelling
from ledgerloom.llm.queries import QUERIES

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows, damage=None):
    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if damage and h % damage == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            out[word] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts):
    near = {w: [] for w in counts}
    for a, b in combinations(counts, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return out


def as_set(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.mark.parametrize("part", [3, 512])
def test_variants_against_brute_force(spark, part):
    draw = random.Random(8)
    counts = {}
    while len(counts) < 400:
        word = "".join(draw.choices("abé", k=draw.randint(6, 8)))
        counts[word] = draw.choice([5, 6, 30, 200, 1000])
    df = spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long"), part=part)
    expected = brute(counts)
    assert as_set(df) == expected
    assert any(r[1] and r[1] != r[2] for r in expected)  # forms of forms


def test_tile_is_one_edit():
    draw = random.Random(9)
    words = list({"".join(draw.choices("ab", k=draw.randint(1, 7))) for _ in range(150)})
    near, _ = spelling.tile(words, words)
    for i, j in combinations(range(len(words)), 2):
        assert near[i, j] == one_edit(words[i], words[j])


def test_whole_documents(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert as_set(QUERIES["op13_spelling"](spark, sf_dir)) == brute(counted(rows, 199))


def test_edges(spark, docs, clashing):
    # À is no a, other scripts, digits and marks end a run, and a run may be as long as a text
    rows = [
        (1, None), (2, ""), (3, "!!"), (4, "Letter LETTER letter Àetter àetter " * 5), (None, "letters " * 6), (4, "let-ter let1ter "),
        (5, "日本letter日本"), (6, "x" * 300_000), (7, "lettér " * 40), (7, "lettér " * 40),
    ]
    for damage in (None, 2):
        assert as_set(spelling.group_spellings(clashing(docs(rows)), damage=damage)) == brute(counted(rows, damage))
    assert spelling.group_spellings(docs([])).count() == 0
    assert spelling.group_spellings(docs(rows[:3])).count() == 0
