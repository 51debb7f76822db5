"""Benchmark decontamination by a positional inverted index, with DataFrame operations only.

Every occurrence of a benchmark word in a training document is a posting (document, term, position).  Postings
are written as the scan of the texts finds them, document after document, so building the index moves
nothing between machines.  A window is ``size`` consecutive words of an item.  Its two rarest terms (by their
postings) are its seed: the lists of the two, each shifted by the term's offset in the item, are intersected
first, on the few postings of rare terms.  What is left names a document, an item and a shift; there
the lists of all words around the seed are intersected the same way.  Runs of ``size`` or more words in step
are exact occurrences.  ``near_matches`` takes the same lists, but only asks for all words of
a window within a span of consecutive words, in any order.

A term that every document holds is spread over documents, for lists are always met by document, term and
position; seeds that windows share are met once.

Nulls and edges: null, empty and blank texts have no words, and an item without words has no window.  An item of
fewer words than a window is one window.  Items of equal words are looked for once and all named; an item without an
id marks words as hit but is not counted or named; an id that repeats is one item with all its texts.  Documents
that repeat an id, or have none, are documents of their own; equal rows give equal results.  Empty
tables give an empty result, or documents without hits.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.common import lower_ascii, stored
from ledgerloom.session import materialize

# Upper-case letters belong to words here; they are lowered word by word.
GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
DOC = ["doc", "print"]  # an id alone may name several texts


def lower_word(word: Column) -> Column:
    """A-Z lowered, nothing else; most words have none and pass by the cheap comparison."""
    return F.when(F.lower(word) == word, word).otherwise(lower_ascii(word))


def word_list(text: Column, gaps: str = GAPS) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), gaps), "")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``text`` and the key of a document: its id, or 0, and a hash of id and text."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.select("id", "text", F.coalesce("id", F.lit(0)).alias("doc"), F.xxhash64("id", "text").alias("print"))


def item_words(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``item``, ``words`` of the distinct texts, and ``item``, ``item_id`` of all who have them."""
    lowered = F.transform(word_list(F.col(text_col).cast("string")), lower_word)
    rows = items.select(F.col(id_col).cast("string").alias("item_id"), lowered.alias("words")).where(F.size("words") > 0)
    texts = rows.select("words").distinct().withColumn("item", F.monotonically_increasing_id())
    texts = stored(texts, "items")
    names = rows.where("item_id is not null").distinct().join(texts, "words").select("item", "item_id")
    return texts, stored(names, "item-names")


def vocabulary(texts: DataFrame) -> DataFrame:
    """``word`` and ``term``, a number for each distinct word of the items."""
    words = texts.select(F.explode("words").alias("word")).distinct()
    return stored(words.withColumn("term", F.monotonically_increasing_id()), "terms")


def postings(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index: ``doc``, ``print``, ``term``, ``pos`` of every occurrence of a term.

    The planner broadcasts the terms while their table is below the session's threshold; beyond
    it, the join is an ordinary one in which hot words are split.
    """
    spread = keyed(docs, id_col, text_col).select(*DOC, F.posexplode(word_list(F.col("text"))).alias("pos", "word"))
    lowered = spread.withColumn("word", lower_word(F.col("word")))
    return stored(lowered.join(terms, "word").select(*DOC, "term", "pos"), "postings")


def item_windows(texts: DataFrame, terms: DataFrame, index: DataFrame, size: int) -> DataFrame:
    """``item``, ``first``, ``n`` and ``parts`` of every window whose words all have postings.

    ``parts`` holds (number of postings, term, offset in the item), the rarest first.
    """
    counts = index.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    known = stored(terms.join(counts, "term"), "term-counts")
    spread = texts.select("item", F.size("words").alias("of"), F.posexplode("words").alias("off", "word"))
    coded = spread.join(known, "word")
    # the windows that a word stands in: those that begin up to ``size - 1`` words before it
    last = F.greatest(F.col("of") - size, F.lit(0))
    begins = F.sequence(F.greatest(F.col("off") - size + 1, F.lit(0)), F.least("off", last))
    placed = coded.withColumn("first", F.explode(begins))
    part = F.struct("df", "term", "off")
    grouped = placed.groupBy("item", "first", F.least("of", F.lit(size)).alias("n")).agg(F.array_sort(F.collect_list(part)).alias("parts"))
    return stored(grouped.where(F.size("parts") == F.col("n")), "windows")


def seeds(windows: DataFrame) -> DataFrame:
    """Distinct seeds: ``one``, ``two``, ``gap``, with item, offset ``at`` and the terms they stand for.

    Windows of an item with the same two rarest words are one seed.  ``codes`` are the offsets and terms of
    all these windows, at most two windows' worth.  A window of one word has no ``two``.
    """
    one, two = F.col("parts")[0], F.get("parts", F.lit(1))
    rows = windows.select(
        "item", "n", "parts", one["term"].alias("one"), one["off"].alias("at"), two["term"].alias("two"), (two["off"] - one["off"]).alias("gap")
    )
    placed = F.transform("parts", lambda p: F.struct(p["off"].alias("off"), p["term"].alias("term")))
    codes = F.array_distinct(F.flatten(F.collect_list(placed)))
    return rows.groupBy("item", "n", "one", "at", "two", "gap").agg(codes.alias("codes"))


def _at_seeds(index: DataFrame, table: DataFrame) -> DataFrame:
    """Where seeds stand: document, ``pos`` of the rarest word, and the seed's ``one``, ``two``, ``gap``."""
    shapes = stored(table.select("one", "two", "gap").distinct(), "shapes")
    rare = shapes.select(F.col("one").alias("term")).union(shapes.where("two is not null").select("two")).distinct()
    # equal rows of the documents would meet each other's postings below
    lists = stored(index.join(stored(rare, "rare"), "term").distinct(), "rare-postings")
    heads = lists.join(shapes, F.col("term") == F.col("one")).select(*DOC, "pos", "one", "two", "gap")
    single = heads.where("two is null")
    # the second list, shifted to where the first word must stand
    pairs = heads.where("two is not null").withColumn("next", F.col("pos") + F.col("gap"))
    other = lists.select(*DOC, F.col("term").alias("two"), F.col("pos").alias("next"))
    both = pairs.join(other, [*DOC, "two", "next"]).select(*DOC, "pos", "one", "two", "gap")
    return both.union(single).distinct()


def exact_runs(index: DataFrame, windows: DataFrame, size: int) -> DataFrame:
    """``doc``, ``print``, ``item``, ``first``, ``last`` (positions) of the longest runs that hold a window."""
    table = stored(seeds(windows), "seeds")
    found = _at_seeds(index, table)
    same = (found["one"] == table["one"]) & found["two"].eqNullSafe(table["two"]) & found["gap"].eqNullSafe(table["gap"])
    shift = F.col("pos") - F.col("at")
    met = found.join(table, same).select(*DOC, "item", "n", shift.alias("shift"), F.explode("codes").alias("code"))
    asked = met.select(*DOC, "item", "n", "shift", F.col("code.off").alias("off"), F.col("code.term").alias("term"))
    asked = asked.withColumn("pos", F.col("shift") + F.col("off")).where("pos >= 0").distinct()
    asked = stored(asked, "asked")
    # only the lists of documents that are left are read on
    left = stored(asked.select(*DOC).distinct(), "documents-left")
    lists = index.join(left, DOC, "left_semi")
    step = [*DOC, "item", "n", "shift"]
    in_step = lists.join(asked, [*DOC, "term", "pos"]).select(*step, "off").distinct()
    order = Window.partitionBy(*step).orderBy("off")
    runs = in_step.withColumn("run", F.col("off") - F.row_number().over(order)).groupBy(*step, "run")
    spans = runs.agg(F.min("off").alias("low"), F.max("off").alias("high")).where(F.col("high") - F.col("low") + 1 >= F.col("n"))
    return spans.select(*DOC, "item", (F.col("shift") + F.col("low")).alias("first"), (F.col("shift") + F.col("high")).alias("last"))


def near_matches(
    docs: DataFrame, items: DataFrame, size: int = 10, span: int = 20, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text",
) -> DataFrame:
    """``doc_id``, ``item_id``, ``window`` and ``start``: proximity matches.

    A window matches where all its different words occur within ``span`` consecutive words in any
    order; ``start`` is the first such place in the document around the rarest word.
    """
    texts, names = item_words(items, item_col, text_col)
    terms = vocabulary(texts)
    index = postings(docs, terms, id_col, text_col)
    windows = item_windows(texts, terms, index, size)
    one = F.col("parts")[0]["term"]
    rest = F.array_except(F.array_distinct(F.col("parts.term")), F.array(one))
    wanted = stored(windows.select("item", F.col("first").alias("window"), one.alias("one"), rest.alias("rest")), "wanted")
    heads = index.join(wanted.select("item", "window", "one", "rest"), F.col("term") == F.col("one"))
    heads = heads.select(*DOC, "item", "window", F.col("pos").alias("at"), "one", "rest").distinct()
    # postings meet by blocks of ``span`` positions: one of three holds every place near enough
    block = F.floor(F.col("at") / span)
    asked = heads.select(
        *DOC, "item", "window", "at", "one", F.size("rest").alias("of"), F.explode("rest").alias("term"),
    ).withColumn("block", F.explode(F.array(block - 1, block, block + 1)))
    lists = index.withColumn("block", F.floor(F.col("pos") / span))
    hits = lists.join(asked, [*DOC, "term", "block"]).where(F.abs(F.col("pos") - F.col("at")) < span)
    occurrence = [*DOC, "item", "window", "at", "one"]
    places = hits.groupBy(*occurrence, "of").agg(F.collect_set(F.struct("pos", "term")).alias("places"))
    places = places.where(F.size(F.array_distinct(F.col("places.term"))) == F.col("of"))
    # at most two spans' worth of places: the first edge from which a span holds every term
    everywhere = F.concat("places", F.array(F.struct(F.col("at").alias("pos"), F.col("one").alias("term"))))

    def holds(edge: Column) -> Column:
        inside = F.filter(everywhere, lambda p: p["pos"].between(edge, edge + span - 1))
        return F.size(F.array_distinct(F.transform(inside, lambda p: p["term"]))) == F.col("of") + 1

    edges = F.filter(F.transform(everywhere, lambda p: p["pos"]), lambda e: (e <= F.col("at")) & holds(e))
    several = places.select(*DOC, "item", "window", F.array_min(edges).alias("start")).where("start is not null")
    single = heads.where(F.size("rest") == 0).select(*DOC, "item", "window", F.col("at").alias("start"))
    found = several.union(single).groupBy(*DOC, "item", "window").agg(F.min("start").alias("start"))
    rows = keyed(docs, id_col, text_col).select("id", *DOC)
    return found.join(names, "item").join(rows, DOC).select(F.col("id").alias("doc_id"), "item_id", "window", "start")


def contamination(
    docs: DataFrame, items: DataFrame, size: int = 10, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: id, n_words, n_hit, n_items and ``item_ids`` (sorted as text)."""
    texts, names = item_words(items, item_col, text_col)
    terms = vocabulary(texts)
    index = postings(docs, terms, id_col, text_col)
    runs = stored(exact_runs(index, item_windows(texts, terms, index, size), size), "runs")
    hit = runs.select(*DOC, F.explode(F.sequence("first", "last")).alias("pos")).distinct()
    hit = hit.groupBy(*DOC).agg(F.count(F.lit(1)).alias("n_hit"))
    named = runs.select(*DOC, "item").distinct().join(names, "item").groupBy(*DOC).agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    found = materialize(hit.join(named, DOC, "left"), "hits")
    rows = keyed(docs, id_col, text_col)
    rows = rows.select("id", *DOC, F.size(word_list(F.col("text"))).cast("long").alias("n_words"))
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    return rows.join(found, DOC, "left").select(
        "id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids")
    )
