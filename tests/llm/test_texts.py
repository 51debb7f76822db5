"""Operators on texts: language model, packing, word pieces, SimHash, chunks."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerloom.llm import bpe, chunks, interpolation, packing, simhash, wordpieces
from ledgerloom.llm.queries import QUERIES

ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "word"), (4, "word"), (None, "no id here"), (5, "long " * 30_000), (6, "é ñ 日本 ß")]


def folder_docs(spark, sf_dir):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]


# --- language model -----------------------------------------------------------------------


def tokens(text):
    return (text or "").encode().lower().split() + [b" end"]


def test_base_scores_and_held_out_gain(spark, sf_dir):
    rows = {r.doc_id: r for r in QUERIES["op1_interpolation"](spark, sf_dir).collect()}
    documents = folder_docs(spark, sf_dir)
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in documents}
    counts = Counter(t for i, x in documents if not held[i] for t in tokens(x))
    total, vocabulary = sum(counts.values()), len(counts)
    assert len(rows) == len(documents)
    gain = 0.0
    for i, text in documents:
        own = tokens(text)
        base = sum(math.log10((counts[t] + 1) / (total + vocabulary + 1)) for t in own)
        row = rows[i]
        assert (row.held_out, row.n_tokens, row.train_tokens) == (held[i], len(own), total)
        assert row.n_known == sum(counts[t] > 0 for t in own)
        assert row.base_score == pytest.approx(base)
        gain += (row.score - row.base_score) if held[i] else 0
    assert gain > 0


def test_interpolation_against_brute_force(docs, monkeypatch):
    random.seed(3)
    words = "a b c d e".split()
    data = [(i, " ".join(random.choices(words, k=random.randint(0, 12)))) for i in range(120)]
    fixed = [[0.6] * interpolation.LEVELS, [0.3] * interpolation.LEVELS]
    monkeypatch.setattr(interpolation, "learn_weights", lambda *_: fixed)
    remainder = F.col("doc_id") % 5
    rows = interpolation.score_documents(docs(data), remainder == 0, remainder == 1, order=2).collect()
    training = [tokens(x) for i, x in data if i % 5]
    one = Counter(t for x in training for t in x)
    two = Counter(p for x in training for p in zip([b"<"] + x, x))
    total = sum(one.values())
    texts = dict(data)
    for row in rows:
        expected, before = 0.0, b"<"
        for t in tokens(texts[row.doc_id]):
            context = len(training) if before == b"<" else one[before]
            p = 0.6 * one[t] / total + 0.4 / (len(one) + 1)
            if context:
                p = 0.3 * two[before, t] / context + 0.7 * p
            expected += math.log10(p)
            before = t
        assert row.score == pytest.approx(expected)


def test_learned_weights_beat_even_ones(spark, docs):
    random.seed(4)
    chain = {w: random.sample("abcdefgh", 2) for w in "abcdefgh"}
    data = []
    for i in range(300):
        word, text = random.choice("abcdefgh"), []
        for _ in range(30):
            text.append(word)
            word = random.choice(chain[word])
        data.append((i, " ".join(text)))
    remainder = F.col("doc_id") % 5

    def held(order):
        rows = interpolation.score_documents(docs(data), remainder == 0, remainder == 1, order=order)
        return rows.where("held_out").agg(F.sum("score") / F.sum("n_tokens")).first()[0]

    one, two, three = (held(k) for k in (1, 2, 3))
    assert two > one + 0.3  # close to one bit a word once the word before is known
    assert three > one + 0.3


def test_interpolation_edges(spark, docs, clashing):
    frame = clashing(docs(ODD))
    remainder = interpolation.id_remainder()
    rows = interpolation.score_documents(frame, remainder == 2, remainder == 3).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in rows) == [(0, 4), (1, 1), (2, 1), (3, 1), (4, 2), (4, 2), (5, 30_001), (6, 5)]
    assert all(math.isfinite(r.score) and r.score <= 0 for r in rows)
    assert interpolation.score_documents(docs([]), remainder == 2, remainder == 3).count() == 0
    nothing = interpolation.score_documents(frame, F.lit(True), F.lit(False)).collect()
    assert {r.train_tokens for r in nothing} == {0} and all(r.score == 0 for r in nothing)


# --- packing ----------------------------------------------------------------------------------


def check_packing(rows, texts, limit=2048):
    encoder = Tokenizer.from_file(bpe.vocabulary_path())
    at, taken = {}, {}
    for r in rows:
        at.setdefault(r.sequence_id, []).append((r.offset, r.length))
        taken.setdefault(r.doc_id, []).append(r)
    for spans in at.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
        assert sum(n for _, n in spans) <= limit
    for name, text in texts:
        ids = encoder.encode(text or "", add_special_tokens=False).ids + [1]
        parts = sorted(taken[name], key=lambda r: r.start)
        assert {r.doc_tokens for r in parts} == {len(ids)}
        assert [r.start for r in parts] == [sum(p.length for p in parts[:i]) for i in range(len(parts))]
        for r in parts:
            piece = np.array(ids[r.start : r.start + r.length], "<u4")
            assert len(piece) == r.length and zlib.crc32(piece) == r.ids_crc32
    return at


def test_packing_of_the_documents(spark, sf_dir):
    rows = QUERIES["op2_packing"](spark, sf_dir).collect()
    sequences = check_packing(rows, folder_docs(spark, sf_dir))
    assert sorted(sequences) == list(range(len(sequences)))
    assert sum(r.length for r in rows) / (2048 * len(sequences)) > 0.95


def test_packing_edges(spark, docs, clashing):
    rows = packing.pack_documents(clashing(docs(ODD))).collect()
    check_packing(rows, [])
    assert sum(r.length for r in rows if r.doc_id == 4) == 2 * next(r.doc_tokens for r in rows if r.doc_id == 4)
    again = packing.pack_documents(docs(ODD)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert packing.pack_documents(docs([])).count() == 0
    with_ids = packing.pack_documents(docs(ODD), with_ids=True).collect()
    assert all(len(r.ids) == r.length and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4")) for r in with_ids)


def test_shortest_pack_first_places_everything():
    random.seed(5)
    for _ in range(50):
        limit = random.randint(2, 60)
        histogram = {n: random.randint(1, 500) for n in random.sample(range(1, limit + 1), random.randint(1, limit))}
        packs = packing.shortest_pack_first(histogram, limit)
        placed = Counter()
        for count, pack in packs:
            assert sum(pack) <= limit and count > 0
            for n in pack:
                placed[n] += count
        assert placed == histogram


def test_batch_encoder_equals_the_tokenizer():
    texts = ["a  b   c\n  d  e　 f \t g  ", None, "", "  lead", "é  x  y", "tail \n\n", "<|endoftext|> it's  we'll\x1c x\x85 y", "日本 語",
             "a <|endoftext|> b", " x<|endoftext|>  <|endoftext|>y \n<|endoftext|>\n", "<|endoftext|", " <|endoftext|><|endoftext|>z <| endoftext|>"]
    encoder = Tokenizer.from_file(bpe.vocabulary_path())
    found = list(bpe.encode_batch(pa.array(texts, pa.string()), bpe.vocabulary_path()))
    assert [x.tolist() for x in found] == [encoder.encode(t or "", add_special_tokens=False).ids for t in texts]


# --- word pieces ------------------------------------------------------------------------------


def greedy(word, begins, continues):
    count, at = 0, 0
    while at < len(word):
        known = continues if at else begins
        end = next((e for e in range(len(word), at, -1) if word[at:e] in known), None)
        if end is None:
            return 1
        count, at = count + 1, end
    return count


@pytest.mark.parametrize("narrow", [0, 5, 32])
def test_automaton_against_greedy_matching(monkeypatch, narrow):
    monkeypatch.setattr(wordpieces, "NARROW", narrow)
    random.seed(1)
    pick = lambda n: bytes(random.choices(b"abc", k=n))
    for _ in range(200):
        begins = [pick(random.randint(1, 5)) for _ in range(random.randint(1, 8))]
        continues = [pick(random.randint(1, 5)) for _ in range(random.randint(0, 8))]
        words = [pick(random.randint(0, 12)) for _ in range(30)]
        ends = np.cumsum([len(w) for w in words])
        starts = ends - [len(w) for w in words]
        data = np.frombuffer(b"".join(words), np.uint8)
        found = wordpieces.count_words(wordpieces.build(begins, continues), data, starts, ends)
        assert found.tolist() == [greedy(w, set(begins), set(continues)) for w in words]


def test_word_piece_counts_of_the_documents(spark, sf_dir):
    begins, continues = map(set, wordpieces.read_vocabulary(bpe.vocabulary_path()))
    rows = {r.doc_id: r for r in QUERIES["op3_wordpiece"](spark, sf_dir).collect()}
    documents = folder_docs(spark, sf_dir)
    assert len(rows) == len(documents)
    for i, text in documents[:60]:
        words = (text or "").encode().split()
        assert rows[i].n_words == len(words)
        assert rows[i].n_tokens == sum(greedy(w, begins, continues) for w in words)


def test_one_word_of_a_megabyte(docs):
    begins, continues = map(set, wordpieces.read_vocabulary(bpe.vocabulary_path()))
    word = "".join(random.Random(5).choices(["http", "://", "我们", "x", "ing", "0", "tion", "é"], k=300_000))
    rows = wordpieces.count_tokens(docs([(1, word), (2, f"a {word} b"), (3, word)])).collect()
    longest = max(map(len, begins | continues))
    data, at, pieces = word.encode(), 0, 0
    while at < len(data):
        known = continues if at else begins
        at = next(e for e in range(min(len(data), at + longest), at, -1) if data[at:e] in known)
        pieces += 1
    ends = sum(greedy(w, begins, continues) for w in (b"a", b"b"))
    assert {r.doc_id: r.n_tokens for r in rows} == {1: pieces, 2: pieces + ends, 3: pieces}


def test_words_without_a_begin_piece_are_cut_after_the_lone_blank(docs):
    begins, continues = map(set, wordpieces.read_vocabulary(bpe.vocabulary_path()))
    known = {b" " + p for p in begins} | continues | {b" "}
    words = ["сейчас", "текст", "это", "работа", "中国", "一个", "한국어", "ไทย", "עברית", "我们在一个没有空格的句子里写了很多字", "hello"]

    def marked(word):
        text, at, count = b" " + word.encode(), 0, 0
        while at < len(text):
            at = next(e for e in range(len(text), at, -1) if text[at:e] in known)
            count += 1
        return count

    rows = wordpieces.count_tokens(docs(list(enumerate([*words, " ".join(words)])))).collect()
    expected = [marked(w) for w in words]
    assert {r.doc_id: r.n_tokens for r in rows} == dict(enumerate([*expected, sum(expected)]))
    assert min(expected[:-1]) > 1


def test_automaton_with_a_lone_marker():
    random.seed(2)
    pick = lambda n: bytes(random.choices(b"abc", k=n))
    for _ in range(200):
        begins = [pick(random.randint(1, 4)) for _ in range(random.randint(0, 6))]
        continues = [pick(random.randint(1, 4)) for _ in range(random.randint(1, 8))]
        words = [pick(random.randint(1, 12)) for _ in range(30)]
        ends = np.cumsum([len(w) for w in words])
        data = np.frombuffer(b"".join(words), np.uint8)
        found = wordpieces.count_words(wordpieces.build([*begins, b""], continues), data, ends - [len(w) for w in words], ends)

        def slow(word):
            if any(word.startswith(b) for b in begins):
                return greedy(word, set(begins), set(continues))
            rest = greedy(word, set(continues), set(continues))
            covered = rest > 1 or word in continues
            return 1 + rest if covered else 1

        assert found.tolist() == [slow(w) for w in words]


def test_word_piece_edges(docs, clashing, monkeypatch):
    rows = wordpieces.count_tokens(clashing(docs(ODD))).collect()
    words = sorted((r.doc_id or 0, r.n_words) for r in rows)
    assert words == [(0, 3), (1, 0), (2, 0), (3, 0), (4, 1), (4, 1), (5, 30_000), (6, 4)]
    assert wordpieces.count_tokens(docs([])).count() == 0


# --- SimHash -----------------------------------------------------------------------------------


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def union(pairs, names):
    root = {n: n for n in names}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in names}


def test_simhash_against_brute_force(spark, sf_dir):
    documents = folder_docs(spark, sf_dir)
    prints = {i: slow_fingerprint(t) for i, t in documents}
    names = sorted(prints)
    pairs = [(a, b) for k, a in enumerate(names) for b in names[:k] if (prints[a] ^ prints[b]).bit_count() <= 4]
    roots = union(pairs, names)
    rows = QUERIES["op8_simhash"](spark, sf_dir).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in rows} == {(i, f"{prints[i]:016x}", roots[i]) for i in names}
    assert any(roots[i] != i for i in names)


@pytest.mark.parametrize("part", [3, 1024])
def test_links_of_near_fingerprints_survive_small_parts(spark, part):
    random.seed(7)
    centres = [random.getrandbits(64) for _ in range(4)]
    values = set(centres)
    for _ in range(120):
        v = random.choice(centres)
        for b in random.sample(range(64), random.randint(0, 6)):
            v ^= 1 << b
        values.add(v)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    nodes = spark.createDataFrame([(s,) for s in signed], "fp long")
    edges = [(r.a, r.b) for r in simhash.links(nodes, 4, part).collect()]
    plain = dict(zip(signed, values))
    assert all((plain[a] ^ plain[b]).bit_count() <= 4 for a, b in edges)
    true = [(a, b) for k, a in enumerate(signed) for b in signed[:k] if (plain[a] ^ plain[b]).bit_count() <= 4]
    assert union(edges, signed) == union(true, signed)


def test_simhash_edges(spark, docs, clashing):
    rows = simhash.near_duplicates(clashing(docs(ODD))).collect()
    got = sorted((r.id or 0, r.component) for r in rows)
    assert got[1:4] == [(1, 1), (2, 1), (3, 1)] and got[4] == got[5] == (4, 4)
    assert simhash.near_duplicates(docs([])).count() == 0
    kept = simhash.keep_one(docs(ODD)).collect()
    assert sorted(r.doc_id or 0 for r in kept) == [0, 1, 4, 5, 6]
    assert kept[0].__fields__ == docs([]).columns


# --- chunks ---------------------------------------------------------------------------------------


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(n))


def test_cuts_depend_on_the_neighbourhood_only():
    text = prose(1, 400).encode()
    whole = set(chunks.cut_places(np.frombuffer(text, np.uint8)).tolist())
    moved = b"an insertion in front " + text
    shifted = {c - 22 for c in chunks.cut_places(np.frombuffer(moved, np.uint8)).tolist()}
    assert {c for c in whole if c > 60} == {c for c in shifted if c > 60}
    starts, ends, words, _ = chunks.chunk_rows(text)
    assert starts[0] == 0 and ends[-1] == len(text) and (starts[1:] == ends[:-1]).all() and words.sum() == 400


def test_slabs_do_not_move_cuts(monkeypatch):
    data = np.frombuffer((prose(2, 900) + " é日本").encode(), np.uint8)
    expected = chunks.cut_places(data)
    monkeypatch.setattr(chunks, "SLAB", 100)
    assert (chunks.cut_places(data) == expected).all()


def test_planted_passages_are_found_and_clean_documents_left(spark, docs):
    passage = [prose(100 + i, 60) for i in range(20)]
    rows = [(i, prose(i, 80)) for i in range(60)]
    for i, p in enumerate(passage):
        for j in (3 * i, 3 * i + 1):  # documents 2, 5, 8, ... stay clean
            rows[j] = (j, f"{prose(1000 + j, 30 + j)} {p} {prose(2000 + j, 25)}")
    found = chunks.repeated_spans(docs(rows), 20).collect()
    assert {r.id for r in found} <= {3 * i + 1 for i in range(20)}
    assert len({r.id for r in found}) >= 19
    assert all(r.kept_ids == [r.id - 1] for r in found)
    texts = dict(rows)
    for r in found:
        cut = texts[r.id].encode()[r.start : r.end].decode()
        assert cut.strip() in passage[r.id // 3]
    cleaned = {r.doc_id: r.text for r in chunks.deduplicate(docs(rows), 20).collect()}
    assert len(cleaned) == 60
    for i in range(60):
        spans = sorted((r.start, r.end) for r in found if r.id == i)
        raw = texts[i].encode()
        for a, b in reversed(spans):
            raw = raw[:a] + raw[b:]
        assert cleaned[i].encode() == raw


def test_chunk_edges(spark, docs, clashing):
    again = prose(9, 100)
    rows = [*ODD, (7, again), (8, again), (8, again), (9, prose(10, 50)), (9, again), (None, again)]
    found = {(r.id, r.start, r.end) for r in chunks.repeated_spans(clashing(docs(rows)), 20).collect()}
    assert (8, 0, len(again)) in found
    assert not {i for i, _, _ in found} & {None, 7, 9}  # 9 names two texts
    left = chunks.deduplicate(clashing(docs(rows)), 20)
    assert left.columns == clashing(docs(rows)).columns and left.count() == len(rows)
    assert {r.text for r in left.where("doc_id = 8").collect()} == {""}
    assert chunks.deduplicate(docs([])).count() == 0


def test_only_what_occurred_before_is_cut(docs):
    """Short phrases of many documents, in ever new orders, and a few passages that do repeat."""
    rng = random.Random(12)
    phrases = [prose(5000 + i, 5) for i in range(60)]
    rows = [(i, " ".join(rng.choices(phrases, k=40))) for i in range(80)]
    for i in range(5):
        rows[60 + i] = (60 + i, rows[60 + i][1] + " " + prose(7000 + i // 2, 70) + " " + prose(8000 + i, 30))
    texts = {i: t.encode() for i, t in rows}
    runs = {}  # digest of a run -> its holder, by plain dictionaries
    for i, raw in sorted(texts.items()):
        for start, end, _, _, digest in zip(*chunks.run_rows(raw, 20, 400), strict=True):
            runs.setdefault(int(digest), (i, int(start), int(end)))
    expected = {}
    for i, raw in texts.items():
        for start, end, _, _, digest in zip(*chunks.run_rows(raw, 20, 400), strict=True):
            holder, at, until = runs[int(digest)]
            assert texts[holder][at:until] == raw[start:end] and len(raw[start:end].split()) >= 19
            if (holder, at) != (i, start):
                expected.setdefault(i, set()).update(range(max(start, until) if holder == i else start, end))
    found = {}
    for r in chunks.repeated_spans(docs(rows), 20).collect():
        found.setdefault(r.id, set()).update(range(r.start, r.end))
        own = texts[r.id][r.start : r.end]
        assert any(own[:60] in texts[k] for k in r.kept_ids)
        assert abs(r.n_words - len(own.split())) <= 1
    assert found == {i: places for i, places in expected.items() if places}
    assert {61, 63} <= set(found) and 64 not in found


def test_phrases_of_many_documents_are_left(docs):
    """No two neighbouring chunks of a document occur together elsewhere."""
    pieces = [prose(300 + i, 14) for i in range(40)]
    rows = [(i, pieces[i] + " " + prose(900 + i, 30)) for i in range(40)]
    rows.append((99, " ".join(pieces)))
    assert chunks.repeated_spans(docs(rows), 20).count() == 0


def test_scripts_without_blanks(docs):
    rng = random.Random(13)
    passage = "".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(20_000))
    found = chunks.repeated_spans(docs([(1, passage), (2, "前" + passage), (3, passage[::-1])])).collect()
    assert {r.id for r in found} == {2} and sum(r.end - r.start for r in found) > 50_000


def test_copies_of_its_own_lines(docs):
    line = prose(77, 30) + "\n"
    (left,) = chunks.deduplicate(docs([(1, prose(78, 30) + "\n" + line * 50)])).collect()
    assert len(left.text.split()) < 110 and line.strip()[20:120] in left.text


def test_one_passage_that_most_documents_share(spark, docs, monkeypatch):
    passage = prose(55, 60)
    rows = [(i, f"{prose(4000 + i, 12)} {passage} {prose(6000 + i, 12)}") for i in range(150)]
    plain = {(r.id, r.start, r.end) for r in chunks.repeated_spans(docs(rows)).collect()}
    assert {i for i, _, _ in plain} == set(range(1, 150))
    monkeypatch.setattr(chunks, "HOT", 1)  # no digest is hot
    assert {(r.id, r.start, r.end) for r in chunks.repeated_spans(docs(rows)).collect()} == plain


# --- rows that share an id ------------------------------------------------------------------------


def test_every_row_is_decided_by_its_own_group(docs):
    a, b, c = prose(21, 60), prose(22, 60), prose(23, 60)

    def kept(rows):
        return sorted(((r.doc_id, r.text) for r in simhash.keep_one(docs(rows)).collect()), key=str)

    assert kept([(5, a), (5, b)]) == sorted([(5, a), (5, b)])
    assert kept([(1, c), (5, c), (5, a)]) == sorted([(1, c), (5, a)])
    assert kept([(None, a), (3, a), (None, b), (None, b), (None, c)]) == sorted([(3, a), (None, b), (None, c)], key=str)
    assert kept([(7, a)] * 40 + [(8, a)] + [(9, b)] * 3) == [(7, a), (9, b)]


def test_of_equal_rows_the_same_one_stays(docs):
    a = prose(24, 40)
    frame = docs([(1, a, "x"), (1, a, "y"), (1, a, "z"), (2, a, "x")])
    first = simhash.keep_one(frame).collect()
    assert len(first) == 1 and first[0].doc_id == 1
    assert simhash.keep_one(frame.orderBy(F.desc("source")).repartition(3)).collect() == first


@pytest.mark.parametrize("held", [0, 1 << 19])
def test_large_decisions_give_the_same_rows(docs, monkeypatch, held):
    for module in (simhash, chunks):
        monkeypatch.setattr(module, "HELD" if module is chunks else "PART", held or 1024)
    monkeypatch.setattr("ledgerloom.llm.common.HELD", held)
    rows = [(i, prose(i % 20, 60)) for i in range(50)] + [(60, prose(70, 30) + " " + prose(3, 60)[20:])]
    assert sorted(r.doc_id for r in simhash.keep_one(docs(rows)).collect()) == [*range(20), 60]
    lengths = {r.doc_id: len(r.text.split()) for r in chunks.deduplicate(docs(rows)).collect()}
    assert all(lengths[i] == 60 for i in range(20)) and all(lengths[i] == 0 for i in range(20, 50)) and 30 <= lengths[60] < 45
