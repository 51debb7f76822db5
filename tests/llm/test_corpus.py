"""Quality, mixing, chat formatting and the pipeline."""

import math
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from ledgerloom.llm import mixing, quality, quotes, simhash
from ledgerloom.llm.common import ranked
from ledgerloom.llm.queries import ORACLES, QUERIES
from ledgerloom.llm.words import by_size

ODD = [(1, None, "b"), (2, "", None), (3, " \t\n", "a"), (4, "one two three", "b"), (4, "one two three", "b"), (None, "no id", "a"), (5, "long " * 30_000, None)]


def test_all_are_registered():
    names = {n.split("_")[0] for n in QUERIES}
    assert names == {f"op{i}" for i in range(1, 14)} and set(ORACLES) <= set(QUERIES)
    assert QUERIES.items() <= entry.queries().items() and entry.queries()["pipeline"] is corpus_pipeline.run


# --- quality ----------------------------------------------------------------------------------


def test_accuracy_on_labelled_documents(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = QUERIES["op4_weak_labels"](spark, folder).join(labels, "doc_id").collect()
    good = [r.keep for r in rows if r.quality == 1]
    bad = [not r.keep for r in rows if r.quality == 0]
    assert sum(good) / len(good) >= 0.99 and sum(bad) / len(bad) >= 0.95


def test_em_recovers_accuracies():
    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.8  # good
    accuracy = np.array([0.95, 0.9, 0.85, 0.8])
    right = rng.random((20_000, 4)) < accuracy
    votes = np.where(right == truth[:, None], quality.GOOD, quality.BAD)
    votes[rng.random(votes.shape) < 0.3] = quality.ABSTAIN
    patterns, counts = np.unique(quality.pattern_of(votes), return_counts=True)
    model = quality.fit_label_model(dict(zip(patterns.tolist(), counts.tolist())), 4)
    assert model.prior[quality.GOOD] == pytest.approx(0.8, abs=0.03)
    for j in range(4):
        assert model.tables[j, quality.GOOD, quality.GOOD] == pytest.approx(accuracy[j], abs=0.03)
        assert model.tables[j, quality.BAD, quality.BAD] == pytest.approx(accuracy[j], abs=0.06)
    assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.95


def test_em_against_a_loop_over_documents():
    random.seed(3)
    votes = [[random.choice([quality.GOOD, quality.GOOD, quality.BAD, quality.ABSTAIN]) for _ in range(3)] for _ in range(250)]
    good = [1 / (1 + math.exp(3.0 * v.count(quality.BAD) - 0.5 * v.count(quality.GOOD) - 1.0)) for v in votes]
    for _ in range(100):
        prior, chance = [sum(good) + 1, len(good) - sum(good) + 1], {}
        for j in range(3):
            for label in (quality.GOOD, quality.BAD):
                cast = [0.5, 0.5]
                for v, g in zip(votes, good, strict=True):
                    if v[j] != quality.ABSTAIN:
                        cast[v[j]] += g if label == quality.GOOD else 1 - g
                for vote in (quality.GOOD, quality.BAD):
                    chance[j, label, vote] = cast[vote] / sum(cast)
        before, good = good, []
        for v in votes:
            a, b = (prior[k] * math.prod(chance[j, k, x] for j, x in enumerate(v) if x != quality.ABSTAIN) for k in (quality.GOOD, quality.BAD))
            good.append(a / (a + b))
        if max(abs(x - y) for x, y in zip(good, before, strict=True)) < 1e-6:
            break
    table = np.array(votes)
    patterns, counts = np.unique(quality.pattern_of(table), return_counts=True)
    model = quality.fit_label_model(dict(zip(patterns.tolist(), counts.tolist(), strict=True)), 3)
    assert model.posterior(table) == pytest.approx(good, abs=1e-5)


def test_the_training_sample_is_bounded_by_rows(docs):
    words = "the of and to in is that it was for".split()
    texts = [" ".join(words[(i * 7 + j * j) % 10] for j in range(20 + i % 9)) for i in range(400)]
    repeated = [(7, t) for t in texts[:200]] + [(8, "the same row again")] * 150 + [(1000 + i, t) for i, t in enumerate(texts[200:])]

    def drawn(rows, bound):
        return quality._training_rows(quality._rows(docs(rows), "doc_id", "text"), bound).count()

    assert [drawn(repeated, bound) for bound in (10, 150, 1000)] == [10, 150, 550]
    assert drawn([(None, t) for t in texts], 50) == 50


def test_quality_edges(spark, docs, clashing):
    rows = quality.classify(clashing(docs(ODD))).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    empty = [r for r in rows if r.doc_id in (1, 2, 3)]
    assert len({r.score for r in empty}) == 1 and all(r.good_votes == r.bad_votes == 0 for r in empty)
    assert quality.classify(docs([])).count() == 0 and quality.keep_good(docs([])).count() == 0
    frame = clashing(docs(ODD))
    assert quality.keep_good(frame).columns == frame.columns


# --- mixing -------------------------------------------------------------------------------------


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, left, open_names = {}, 1.5 * sum(sizes.values()), list(names)
    while True:
        share = left / sum(weight[s] for s in open_names)
        over = [s for s in open_names if share * weight[s] > 2 * sizes[s]]
        if not over:
            return target | {s: share * weight[s] for s in open_names}
        for s in over:
            target[s] = 2 * sizes[s]
            left -= target[s]
            open_names.remove(s)


def check_mix(rows, documents):
    sizes = {}
    for _, text, source in documents:
        sizes[source] = sizes.get(source, 0) + len((text or "").encode().split())
    wanted, taken = plain_targets(sizes), {}
    assert len(rows) == len(documents)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(wanted[r.source])
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.n_copies * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    return {s: (taken[s], wanted[s]) for s in sizes}


def test_mix_of_the_documents(spark, sf_dir):
    documents = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = mixing.copies(frame).collect()
    for got, wanted in check_mix(rows, documents).values():
        assert abs(got - wanted) <= 0.02 * wanted + 50
    again = mixing.copies(frame.repartition(7)).collect()
    assert sorted((r.id, r.taken) for r in rows) == sorted((r.id, r.taken) for r in again)


def test_hot_source_and_large_documents(spark, docs):
    random.seed(1)
    rows = [(i, "w " * int(random.paretovariate(1.1) * 20), "hot" if i % 3 else f"s{i % 4}") for i in range(900)]
    rows.append((900, "w " * 50_000, "hot"))
    for got, wanted in check_mix(mixing.copies(docs(rows)).collect(), rows).values():
        assert abs(got - wanted) <= 0.01 * wanted + 40


def test_tilts_against_bisection(spark):
    random.seed(4)
    cells, goals = [], {}
    for s in range(6):
        sizes = random.sample(range(1, 3000), 30)
        rows = [(s, size, random.randint(1, 9)) for size in sizes]
        mean = sum(z * n for _, z, n in rows) / sum(n for *_, n in rows)
        cells += [(s, z, n, z / mean) for _, z, n in rows]
        goals[s] = sum(z * n for _, z, n in rows) * (0.05, 0.4, 1.0, 1.5, 1.95, 2.0)[s]
    state = spark.createDataFrame([(s, float(g), 0.0) for s, g in goals.items()], "s int, goal double, tilt double")
    frame = spark.createDataFrame(cells, "s int, size long, n long, x double")
    found = {r.s: r.tilt for r in mixing.solve(frame, state, 2).collect()}
    for s in range(5):
        low, high = -1e3, 1e3
        for _ in range(200):
            tilt = (low + high) / 2
            got = sum(n * z * min(2.0, math.exp(min(tilt * x, 1.0))) for k, z, n, x in cells if k == s)
            low, high = (low, tilt) if got > goals[s] else (tilt, high)
        assert found[s] == pytest.approx(low, abs=1e-4, rel=1e-4)
    assert found[5] == mixing.BEYOND


@pytest.mark.parametrize("share", [0.5, 1.5, 1.99, 3.0])
def test_targets_of_many_sources(spark, share):
    random.seed(8)
    sizes = {f"{random.choice('aZé日')}{i}": int(random.paretovariate(0.6)) for i in range(400)} | {None: 50, "": 7, "empty": 0}
    frame = spark.createDataFrame([(s, z, 1) for s, z in sizes.items()], "source string, size long, n long").repartition(4)
    found = mixing.targets(frame, (3, 1, 2), share, 2).collect()
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    assert [r.source for r in sorted(found, key=lambda r: r.s)] == names and {r.s for r in found} == set(range(len(names)))
    low, high = 0.0, 1e12
    for _ in range(200):
        level = (low + high) / 2
        got = sum(min(2 * sizes[n], (3, 1, 2)[i % 3] * level) for i, n in enumerate(names))
        low, high = (low, level) if got > share * sum(sizes.values()) else (level, high)
    expected = {n: min(2 * sizes[n], (3, 1, 2)[i % 3] * low) for i, n in enumerate(names)}
    assert all(r.target == pytest.approx(expected[r.source], rel=1e-9, abs=1e-9) for r in found)


def test_rows_without_an_id_take_what_one_document_each_would(spark, docs):
    texts = [" ".join(["w"] * (3 + i % 2)) for i in range(3000)]
    rows = [(None if i % 3 else 7 if i % 2 else i, t, "ab"[i % 5 == 0]) for i, t in enumerate(texts)]
    found = mixing.copies(docs(rows)).collect()
    assert len(found) == 3000 and all(0 <= r.n_copies <= 2 and r.taken == r.n_copies * r.size for r in found)
    for source in "ab":
        mine = [r for r in found if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 8
    key = lambda r: (str(r.id), r.source, r.size, r.taken)
    again = mixing.copies(docs(list(reversed(rows))).repartition(5)).collect()
    assert sorted(map(key, found)) == sorted(map(key, again))


def test_mixing_edges(spark, docs, clashing):
    frame = clashing(docs(ODD))
    rows = mixing.copies(frame).collect()
    check_mix(rows, ODD)
    assert all(r.n_copies == 1 and r.taken == 0 for r in rows if r.size == 0)
    mixed = mixing.mix(frame)
    assert mixed.columns == frame.columns
    assert mixed.where("doc_id = 4").count() == sum(r.n_copies for r in rows if r.id == 4)
    assert mixing.copies(docs([])).count() == 0 and mixing.mix(docs([])).count() == 0
    blank = mixing.copies(docs([(1, None, "a"), (2, "", "b")])).collect()
    assert {(r.target, r.taken) for r in blank} == {(0.0, 0)}


def test_mixed_rows_are_their_own_documents(docs):
    """Rows without an id, or with one id, keep their texts; copies are counted for each row."""
    texts = [f"text number {w}" for w in "abcdef"]
    for name in (None, 4):
        rows = mixing.mix(docs([(name, t) for t in texts])).collect()
        taken = [sum(r.text == t for r in rows) for t in texts]
        assert len(rows) == 9 and set(taken) == {1, 2}
        again = mixing.mix(docs([(name, t) for t in reversed(texts)]).repartition(3)).collect()
        assert [sum(r.text == t for r in again) for t in texts] == taken


def test_equal_rows_share_what_is_left(docs):
    rows = [(1, "three equal words", "s")] * 7 + [(2, "three other words", "s"), (3, "three more words", "s")]
    frame = docs(rows).withColumn("lang", F.monotonically_increasing_id().cast("string")).withColumn("_slice", F.lit(0))
    mixed = mixing.mix(frame)
    assert mixed.columns == frame.columns
    got = [r.n for r in mixed.groupBy("doc_id", "lang").agg(F.count("*").alias("n")).collect()]
    assert len(got) == 9 and sum(got) == 14 and set(got) == {1, 2}  # 40.5 words wanted, of three each


def test_mix_takes_what_copies_plans(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    planned = mixing.copies(frame).groupBy("source").agg(F.sum("taken").alias("taken")).collect()
    size = mixing.word_count(F.col("text"))
    taken = mixing.mix(frame).groupBy("source").agg(F.sum(size).alias("taken")).collect()
    assert sorted(map(tuple, planned)) == sorted(map(tuple, taken))


def test_ranks_of_a_hot_key(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "a").alias("k"))
    rows = ranked(df, ["k"], ["id"], F.xxhash64("id"), "place", 16).collect()
    for key, n in (("a", 1000), (None, 2000)):
        assert sorted(r.place for r in rows if r.k == key) == list(range(n))


# --- chat formatting --------------------------------------------------------------------------------

CHAT = "conv_id long, turn long, role string, text string"


def test_quotes_are_linked_and_ordered(spark):
    rows = [
        (1, 0, "u", "Hello there friends\nHow are you today?"),
        (1, 1, "a", "I am fine and well"),
        (1, 2, "u", "Other topic starts here now"),
        (1, 3, "a", "On Monday Bob wrote:\n> how  are you TODAY?\nDoing quite well, thanks"),
        (1, 4, "b", "continuing the answer here"),
        (1, 5, "u", "> > How are you today?\n> Doing quite well, thanks\nGlad to hear that"),
        (1, 6, "x", "> no such text exists\nmystery message"),
        (1, 7, "y", "> I am fine and well\nsuper reply"),
        (2, 0, "u", "How are you today?"),
    ]
    found = quotes.link_quotes(spark.createDataFrame(rows, CHAT)).orderBy("conv_id", "position").collect()
    first = [(r.turn, r.parent_turn, r.text) for r in found if r.conv_id == 1]
    assert [x[0] for x in first] == [0, 3, 5, 6, 4, 1, 7, 2]
    assert {t: p for t, p, _ in first if p is not None} == {3: 0, 5: 3, 7: 1}
    assert {t: x for t, _, x in first}[3] == "Doing quite well, thanks"
    assert all(">" not in x and "wrote:" not in x for _, _, x in first)
    assert [(r.turn, r.n_quotes, r.n_linked) for r in found if r.turn in (5, 6)] == [(5, 2, 2), (6, 1, 0)]


def test_short_messages_are_linked_and_longer_quotes_win(spark):
    rows = [
        (1, 0, "u", "Shall we go on Monday?"),
        (1, 1, "a", "Yes"),
        (1, 2, "u", "ok?"),
        (1, 3, "a", "好的"),
        (1, 4, "b", "Yes\nbut bring the long papers"),
        (1, 5, "u", "> Yes\nfine"),
        (1, 6, "a", "> ok?\nsure"),
        (1, 7, "b", "> 好的\n谢谢"),
        (1, 8, "u", "> Yes\n> but bring the long papers\nI will"),
        (1, 9, "a", ">\n>  \nnothing is quoted"),
    ]
    found = quotes.link_quotes(spark.createDataFrame(rows, CHAT)).orderBy("position").collect()
    assert {r.turn: r.parent_turn for r in found if r.parent_turn is not None} == {5: 1, 6: 2, 7: 3, 8: 4}
    assert [r.n_linked for r in found if r.turn in (5, 6, 7, 8)] == [1, 1, 1, 1]
    assert [r.turn for r in found] == [0, 1, 5, 2, 6, 3, 7, 4, 8, 9]


def preorder(parents):
    below = {}
    for n, p in parents.items():
        if n:
            below.setdefault(n - 1 if p is None else p, []).append((p is None, n))
    out, stack = [], [0]
    while stack:
        n = stack.pop()
        out.append(n)
        stack += [c for _, c in sorted(below.get(n, []), reverse=True)]
    return out


def quote_links(texts):
    """Per message of one conversation: parent, quotes, linked quotes and own words, by looking at every earlier message."""

    def units(body):
        parts = [body, *re.split(r"\n\s*\n", body), *body.split("\n")]
        return {" ".join(p.split()).lower() for p in parts} - {""}

    own, out = [], []
    for n, text in enumerate(texts):
        passages = []
        for line in text.split("\n"):
            level, rest = 0, line
            while rest.lstrip(" ").startswith(">"):
                level, rest = level + 1, rest.lstrip(" ")[1:]
            body = rest.removeprefix(" ") if level else line
            if passages and passages[-1][0] == level:
                passages[-1][1].append(body)
            else:
                passages.append((level, [body]))
        quoted = [(level, "\n".join(body)) for level, body in passages if level]
        own.append("\n".join("\n".join(body) for level, body in passages if not level).strip(" ") if quoted else text)
        chars, linked = {}, 0
        for level, body in quoted:
            hits = [(next((m for m in range(n) if u in units(own[m])), None), len(u)) for u in units(body)]
            hits = [(m, size) for m, size in hits if m is not None]
            linked += bool(hits)
            for m, size in hits:
                chars[level, m] = chars.get((level, m), 0) + size
        best = max(chars, key=lambda k: (-k[0], chars[k], -k[1]), default=(0, None))
        out.append((best[1], len(quoted), linked, own[n]))
    return out


def test_links_against_brute_force(spark):
    random.seed(11)
    phrases = ["Yes", "no way", "see the  plan", "what about Monday?", "ok", "we ship it on friday", "good point", "日本", "why"]
    rows, expected = [], {}
    for conv in range(12):
        texts = []
        for n in range(30):
            lines = []
            while not lines or random.random() < 0.6:
                if n and random.random() < 0.5:  # quotes what was said, or what nobody said
                    said = random.choice([*random.choice(texts).split("\n"), "never said"])
                    lines.append(">" * random.randint(1, 2) + " " * random.randint(0, 1) + said)
                else:
                    lines.append(random.choice([*phrases, f"{random.choice(phrases)} {n}", ""]))
            texts.append("\n".join(lines))
        found = quote_links(texts)
        order = preorder({n: f[0] for n, f in enumerate(found)})
        for n, (parent, quoted, linked, own) in enumerate(found):
            rows.append((conv, n, "u", texts[n]))
            expected[conv, n] = (order.index(n) + 1, parent, quoted, linked, own)
    frame = spark.createDataFrame(rows, CHAT).repartition(5)
    result = quotes.link_quotes(frame).collect()
    assert {(r.conv_id, r.turn): (r.position, r.parent_turn, r.n_quotes, r.n_linked, r.text) for r in result} == expected
    assert sum(e[1] is not None for e in expected.values()) > 100


def test_a_message_with_many_answers(spark, monkeypatch):
    monkeypatch.setattr(quotes, "TURNS", 16)
    rows = [(0, n, 0 if n > 3 and n % 7 else None) for n in range(600)]
    found = quotes.reply_order(spark.createDataFrame(rows, "conv long, n long, parent long")).collect()
    assert [r.n for r in sorted(found, key=lambda r: r.position)] == preorder({n: p for _, n, p in rows})


def test_reply_order_against_a_walk_of_the_tree(spark):
    random.seed(6)
    rows, expected = [], {}
    for conv in range(6):
        parents = {n: (random.randrange(n) if n and random.random() < 0.4 else None) for n in range(40 + conv)}
        expected[conv] = preorder(parents)
        rows += [(conv, n, p) for n, p in parents.items()]
    found = quotes.reply_order(spark.createDataFrame(rows, "conv long, n long, parent long")).collect()
    for conv, order in expected.items():
        assert [r.n for r in sorted((r for r in found if r.conv == conv), key=lambda r: r.position)] == order


def test_conversations_without_quotes_keep_their_order(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    found = QUERIES["op7_quotes"](spark, sf_dir)
    assert found.count() == given.distinct().count()
    assert found.where("position <> turn + 1 and n_quotes = 0").count() == 0
    assert found.join(given.select("conv_id", "turn", "text"), ["conv_id", "turn", "text"], "left_anti").count() == 0


def test_chat_edges(spark):
    rows = [(1, 0, "u", None), (1, 0, "u", None), (None, 0, "u", "> quoted\nown"), (2, None, "u", "x"), (3, 5, "u", "a " * 50_000)]
    frame = spark.createDataFrame(rows, CHAT).withColumn("conv", F.lit("x")).withColumn("n", F.lit(1))
    found = {(r.conv_id, r.turn): (r.position, r.text) for r in quotes.link_quotes(frame).collect()}
    assert found == {(1, 0): (1, ""), (None, 0): (1, "own"), (2, None): (1, "x"), (3, 5): (1, "a " * 50_000)}
    assert quotes.link_quotes(frame.limit(0)).count() == 0


def test_a_task_of_the_classifier_holds_little_beside_its_batch():
    rng = np.random.default_rng(3)
    known = np.array(["".join(chr(97 + c) for c in rng.integers(0, 26, 2 + i % 9)) for i in range(20_000)])
    batch = pa.RecordBatch.from_arrays([pa.array([" ".join(known[rng.integers(0, 20_000, 500)]) for _ in range(4000)])], names=["text"])
    assert batch.nbytes > 12 << 20
    scorer = quality.Scorer(np.zeros(quality.DIMENSIONS), np.zeros(2 * len(quality.LABELLERS)), 0.0)
    seen = 0
    tracemalloc.start()
    try:
        for part in by_size([batch], 0, quality.AT_ONCE):
            words, values = quality.measures(part.column(0))
            assert len(scorer.score(words, values)) == part.num_rows
            seen += part.num_rows
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert seen == 4000 and peak < 40 << 20, peak


# --- pipeline ------------------------------------------------------------------------------------------


def test_pipeline_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sizes = [docs.count()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        if name != "packing":
            assert out.columns == docs.columns, name
        out.write.parquet(str(tmp_path / str(i)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(i)))
        sizes.append(docs.count())
        if "near" in name:
            groups = simhash.near_duplicates(before).groupBy("component").count().count()
            assert sizes[-1] == groups
        if "mix" in name:
            assert sorted(r.taken for r in mixing.copies(before).where("n_copies > 0").collect())
    assert sizes[1] < sizes[0] and sizes[2] < sizes[1] and sizes[3] == sizes[2]
    assert docs.agg(F.max(F.col("offset") + F.col("length"))).first()[0] <= 2048
    run = corpus_pipeline.run(spark, sf_dir)
    assert run.agg(F.sum("length")).first() == docs.agg(F.sum("length")).first()


def test_texts_reach_python_in_small_batches(spark, docs, setting, tmp_path):
    setting("spark.sql.execution.arrow.maxBytesPerBatch", "64m")
    docs([(i, "some words of a text " * 500) for i in range(1500)]).coalesce(1).write.parquet(str(tmp_path / "docs"))
    frame = spark.read.parquet(str(tmp_path / "docs")).coalesce(1)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])

    for _, stage in corpus_pipeline.STAGES:
        setting("spark.sql.execution.arrow.maxBytesPerBatch", "64m")
        stage(spark, frame.limit(0), "")
        found = frame.mapInArrow(sizes, "n long, size long").collect()
        assert sum(r.n for r in found) == 1500 and max(r.size for r in found) < 5 << 20


def test_pipeline_of_an_empty_table(spark, docs):
    frame = docs([])
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, "")
    assert frame.count() == 0


def test_pieces_that_end_in_a_blank_are_told_from_their_bytes():
    import numpy as np

    from ledgerloom.llm import bpe

    words = [" a", "b ", "\u0085", " x ", "é", "ã　", "\x1c", "y\x1f", "中", " ", "😀", "à", " ", " …"]
    parts = [w.encode() for w in words]
    bounds = np.cumsum([0, *map(len, parts)])
    found = bpe._ends_blank(np.frombuffer(b"".join(parts), np.uint8), bounds)
    assert found.tolist() == [w[-1].isspace() for w in words]
