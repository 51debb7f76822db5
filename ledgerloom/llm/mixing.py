"""Mixing sources to target weights by entropy balancing, with DataFrame operations only.

Rates are as close to one copy of every document as the token constraints allow, in the sense of
relative entropy.  The solution is an exponential tilt: ``rate = min(cap, exp(tilt * size / mean))``,
where each source's tilt is the root of its convex dual.  Newton steps, kept inside a
bracket, find all tilts at once; each step is one aggregation over the distinct (source, size) cells,
whose sums are decimals and so do not depend on the order of the rows: reruns agree.

Rates become whole copies in a few levels, from the largest documents to the smallest.  A
level is rounded so that its running total follows the rates; what it misses is added to the target
of the levels below, for which the dual is solved again.  A source so ends near its target,
by about the size of its small documents.  Within a cell the extra copies go to documents by
a hash of their id.

Nulls and edges: a null text has size 0; such documents take no words and keep one copy.  A null source
is a source, ordered last.  Rows that repeat an id are documents of their own.  An empty table gives
an empty result; where all sizes are 0, targets are 0.  Clashing names of other columns do
not matter, for only id, text and source are read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.common import beside, ranked, stored, task_count, unused, word_count
from ledgerloom.operators.ranking import with_global_position
from ledgerloom.session import settled

EXACT = "decimal(38,9)"  # sums of doubles that do not depend on their order
LEVELS = 4
STEPS = 60
CLOSE = 1e-7
BEYOND = 1e15  # a tilt at which every rate is the cap, or none


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size")
    )


def targets(cells: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """One row per source: ``s`` (its place by code point), ``source_size`` and ``target``.

    A target is ``min(cap * source_size, weight * level)``.  The level is what an open source gets per weight; sources
    above their most are closed and the excess is reshared until none is.  Each round is one aggregation.
    """
    sizes = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    placed = with_global_position(sizes, [F.col("source").asc_nulls_last()], "place").withColumn("s", F.col("place") - 1)
    listed = F.array(*[F.lit(float(w)) for w in weights])
    rows = placed.withColumn("weight", F.get(listed, (F.col("s") % len(weights)).cast("int")))
    rows = stored(rows.withColumn("most", F.lit(float(cap)) * F.col("source_size")), "sources")
    level, closed = -math.inf, None
    while True:
        above = F.col("weight") * F.lit(level) > F.col("most")
        found = rows.agg(
            F.count_if(above).alias("closed"),
            F.sum(F.when(above, F.col("most")).cast(EXACT)).alias("taken"),
            F.sum(F.when(~above, F.col("weight")).cast(EXACT)).alias("open"),
            F.sum("source_size").alias("whole"),
        ).first()
        if found.closed == closed:  # levels only rise, so no source was closed since
            break
        closed = found.closed
        if not found.open:  # all get their most
            level = math.inf
            break
        level = (float(share) * found.whole - float(found.taken or 0)) / float(found.open)
    return rows.select("s", "source", "source_size", F.least("most", F.col("weight") * F.lit(level)).alias("target"))


def _rate(cap: float):
    """exp(tilt * x), never above the cap and without overflow."""
    return F.when(F.col("tilt") * F.col("x") >= math.log(cap), F.lit(cap)).otherwise(F.exp(F.col("tilt") * F.col("x")))


def solve(cells: DataFrame, state: DataFrame, cap: float) -> DataFrame:
    """``s`` and ``tilt`` with ``sum(n * size * rate) = goal`` for every source of ``state`` (s, goal, tilt).

    ``cells``: s, size, n and x, the size over the source's mean.
    """
    most = cells.groupBy("s").agg(F.sum(F.col("n") * F.col("size")).alias("most"))
    everything, nothing = F.col("goal") >= cap * F.col("most") * (1 - CLOSE), F.col("goal") <= 0
    # a source that wants all or nothing has no finite tilt: no step is needed for it
    state = state.join(most, "s").select(
        "s",
        "goal",
        F.when(everything, BEYOND).when(nothing, -BEYOND).otherwise(F.col("tilt")).alias("tilt"),
        F.lit(None).cast("double").alias("low"),
        F.lit(None).cast("double").alias("high"),
        (everything | nothing).alias("fixed"),
    )
    for _ in range(STEPS):
        tokens = F.col("n") * F.col("size") * _rate(cap)
        free = F.col("tilt") * F.col("x") < math.log(cap)
        sums = (
            cells.join(state, "s")
            .groupBy("s", "goal", "tilt", "low", "high", "fixed")
            .agg(
                F.sum(tokens.cast(EXACT)).cast("double").alias("got"),
                F.sum(F.when(free, tokens * F.col("x")).otherwise(0.0).cast(EXACT)).cast("double").alias("slope"),
            )
        )
        over = F.col("got") > F.col("goal")
        sums = sums.withColumns(
            {
                "low": F.when(over, F.col("low")).otherwise(F.col("tilt")),
                "high": F.when(over, F.col("tilt")).otherwise(F.col("high")),
                "off": F.abs(F.col("got") - F.col("goal")) / F.greatest(F.abs("goal"), F.lit(1.0)),
            }
        )
        # Newton on the logarithm, in which an exponential is a straight line
        step = F.log(F.col("got") / F.col("goal")) * F.col("got") / F.col("slope")
        newton = F.when((F.col("slope") > 0) & (F.col("got") > 0) & (F.col("goal") > 0), F.col("tilt") - step)
        inside = (F.coalesce("low", F.lit(-math.inf)) < newton) & (newton < F.coalesce("high", F.lit(math.inf)))
        # no bracket on one side yet: go that way in growing strides
        stride = F.when(over, -1.0).otherwise(1.0) * (1 + F.abs("tilt"))
        near = (newton - F.col("tilt")).between(-1 - 4 * F.abs("tilt"), 1 + 4 * F.abs("tilt"))
        middle = F.when(F.col("low").isNotNull() & F.col("high").isNotNull(), (F.col("low") + F.col("high")) / 2)
        moved = F.when(inside & (near | middle.isNotNull()), newton).otherwise(F.coalesce(middle, F.col("tilt") + stride))
        done = F.col("fixed") | (F.col("off") < CLOSE)
        kept = F.when(done, F.col("tilt")).otherwise(moved)
        state = stored(sums.select("s", "goal", kept.alias("tilt"), "low", "high", "fixed", "off"), "tilts")
        narrow = F.col("high") - F.col("low") <= 1e-13 * (1 + F.abs("tilt"))
        unsettled = state.where(~F.col("fixed") & (F.col("off") >= CLOSE) & ~F.coalesce(narrow, F.lit(False)))
        if unsettled.isEmpty():
            break
    return state.select("s", "tilt")


def _planned(rows: DataFrame, weights: Sequence[float], share: float, cap: int) -> tuple[DataFrame, DataFrame]:
    """For rows of (source, size): the sources with their targets, and ``k`` copies for each cell of ``n`` rows."""
    counts = stored(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "cells")
    sources = stored(targets(counts, weights, share, cap), "targets")
    small_first = Window.partitionBy("s").orderBy("size")
    up_to = F.sum(F.col("size") * F.col("n")).over(small_first) / F.col("source_size")
    mean = F.col("source_size") / F.sum("n").over(Window.partitionBy("s"))
    cells = (
        counts.join(sources, counts["source"].eqNullSafe(sources["source"]))
        .where("size > 0")
        .select("s", "size", "n", "source_size")
        .withColumn("x", F.col("size") / mean)
        # level 0 are the largest, which hold three quarters of the words; and so on downwards
        .withColumn("level", F.least(F.lit(LEVELS - 1), F.floor(-F.log(4.0, up_to) + 1e-12)).cast("int"))
        .select("s", "size", "n", "x", "level")
    )
    cells = stored(cells, "levels")
    state = sources.select("s", F.col("target").alias("goal"), F.lit(0.0).alias("tilt"))
    rounded = []
    for level in range(LEVELS):
        left = cells.where(F.col("level") >= level)
        tilts = solve(left, state, cap)
        now = cells.where(F.col("level") == level).join(tilts, "s").withColumn("wanted", F.col("n") * _rate(cap))
        large_first = Window.partitionBy("s").orderBy(F.col("size").desc())
        running = F.sum("wanted").over(large_first)
        now = now.withColumn("end", F.floor(running + 0.5))
        now = now.withColumn("k", F.col("end") - F.coalesce(F.lag("end").over(large_first), F.lit(0)))
        now = now.withColumn("k", F.least(F.greatest("k", F.lit(0)), F.col("n") * cap).cast("long"))
        rounded.append(stored(now.select("s", "size", "n", "k"), "rounded"))
        got = rounded[-1].groupBy("s").agg(F.sum(F.col("k") * F.col("size")).alias("got"))
        goals = state.join(got, "s", "left").select("s", (F.col("goal") - F.coalesce("got", F.lit(0))).alias("goal"))
        state = stored(goals.join(tilts, "s", "left").select("s", "goal", F.when(F.abs("tilt") < BEYOND, F.col("tilt")).otherwise(0.0).alias("tilt")), "goals")
    planned = rounded[0]
    for part in rounded[1:]:
        planned = planned.union(part)
    return sources, planned


def _decide(rows: DataFrame, weights: Sequence[float], share: float, cap: int) -> tuple[DataFrame, DataFrame]:
    """For rows of (source, size, mark): the sources, and what each of their cells takes.

    A cell takes ``base`` copies of every row and one more of those with a mark up to ``upto``.
    Where ``same`` rows have that very mark, only ``spare`` of them get one more.
    """
    sources, planned = _planned(rows.select("source", "size"), weights, share, cap)
    cells = planned.join(sources.select("s", "source"), "s").withColumn("rest", F.col("k") % F.col("n"))
    cells = stored(cells.select("s", "source", "size", "rest", F.floor(F.col("k") / F.col("n")).cast("int").alias("base")), "planned")
    some = cells.where("rest > 0").select("s", F.col("source").alias("origin"), F.col("size").alias("words"), "rest")
    drawn = rows.join(some, rows["source"].eqNullSafe(some["origin"]) & (rows["size"] == some["words"])).select("s", "size", "rest", "mark")
    # rows are numbered by mark, in slices of the marks' range; equal marks are one row by now
    marks = drawn.groupBy("s", "size", "rest", "mark").agg(F.count(F.lit(1)).alias("same"))
    marks = marks.withColumn("slice", F.shiftright("mark", 56))
    earlier = Window.partitionBy("s", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = marks.groupBy("s", "size", "slice").agg(F.sum("same").alias("of"))
    slices = slices.withColumn("start", F.coalesce(F.sum("of").over(earlier), F.lit(0))).drop("of")
    lower = Window.partitionBy("s", "size", "slice").orderBy("mark").rowsBetween(Window.unboundedPreceding, -1)
    within = marks.withColumn("below", F.coalesce(F.sum("same").over(lower), F.lit(0)))
    placed = within.join(slices, ["s", "size", "slice"]).withColumn("first", F.col("start") + F.col("below"))
    last = placed.where("first < rest").groupBy("s", "size").agg(
        F.max("mark").alias("upto"),
        F.max_by("same", "mark").alias("same"),
        F.max_by(F.least("same", F.col("rest") - F.col("first")), "mark").alias("spare"),
    )
    return sources, cells.join(last, ["s", "size"], "left").select("source", "size", "base", "upto", "same", "spare")


def _cell_decisions(docs: DataFrame, weights: Sequence[float], share: float, cap: int, source_col: str, size, mark) -> DataFrame:
    """What each cell (source, size) takes."""
    rows = stored(docs.select(F.col(source_col).cast("string").alias("source"), size.alias("size"), mark.alias("mark")), "sizes")
    return _decide(rows, weights, share, cap)[1]


def copies(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: int = 2, id_col: str = "doc_id",
           text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: id, source, size, source_size, target, n_copies and taken (words).

    Rows of one cell that share an id, or have none, are interchangeable: which of them get one more does not show. Only where
    some of them do and others don't are they numbered, in slices.
    """
    # stored with a number, so that equal rows can be told apart from here on
    marked = sized(docs, id_col, text_col, source_col).withColumn("mark", F.xxhash64("id"))
    rows = stored(marked.withColumn("row", F.monotonically_increasing_id()), "sizes")
    sources, decided = _decide(rows.select("source", "size", "mark"), weights, share, cap)
    cells = stored(decided.toDF("origin", "words", "base", "upto", "same", "spare"), "cell-copies")
    named = rows.join(sources, rows["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    joined = named.join(cells, F.col("source").eqNullSafe(F.col("origin")) & (F.col("size") == F.col("words")), "left")
    tied = F.coalesce((F.col("mark") == F.col("upto")) & (F.col("same") > F.col("spare")), F.lit(False))
    more = F.when(F.col("mark") <= F.col("upto"), 1).otherwise(0)
    columns = ["id", "source", "size", "source_size", "target"]

    def counted(df: DataFrame, more) -> DataFrame:
        times = F.when(F.col("size") == 0, 1).otherwise(F.coalesce(F.col("base") + more, F.lit(0))).cast("int")
        return df.select(*columns, times.alias("n_copies"), (times * F.col("size")).alias("taken"))

    if cells.where("same > spare").isEmpty():
        return counted(joined, more)
    equal = ranked(joined.where(tied), ["origin", "words"], ["row"], F.xxhash64("row"), "place", task_count(docs))
    some = F.when(F.col("place") < F.col("spare"), 1).otherwise(0)
    return counted(joined.where(~tied), more).unionByName(counted(equal, some))


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: int = 2, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it.

    Every row is a document, also those that repeat an id or have none.  Which rows of a cell (source,
    size) are taken once more follows from a hash of id, source and text, so the texts meet only the small table of
    cells.  Rows equal in all three are interchangeable; they are numbered where not all get one more.
    """
    size = word_count(F.col(text_col).cast("string"))
    mark = F.xxhash64(F.col(id_col), F.col(source_col).cast("string"), F.col(text_col).cast("string"))
    found = settled(
        docs.sparkSession, lambda: _cell_decisions(docs, weights, share, cap, source_col, size, mark), "cell-copies"
    )
    own_size, own_mark, origin, words, base, upto, same, spare, again = (
        unused(docs, n) for n in ("_size", "_mark", "_source", "_words", "_base", "_upto", "_same", "_spare", "_again")
    )
    table = beside(found.toDF(origin, words, base, upto, same, spare))
    rows = docs.withColumns({own_size: size, own_mark: mark})
    joined = rows.join(table, rows[source_col].cast("string").eqNullSafe(table[origin]) & (rows[own_size] == table[words]), "left")
    tied = (F.col(own_mark) == F.col(upto)) & (F.col(same) > F.col(spare))
    more = F.when(F.col(own_mark) <= F.col(upto), 1).otherwise(0)
    times = F.when(F.col(own_size) == 0, 1).otherwise(F.coalesce(F.col(base) + more, F.lit(0)))

    def repeated(df: DataFrame, times) -> DataFrame:
        return df.withColumn(again, F.explode(F.array_repeat(F.lit(1), times.cast("int")))).select(*docs.columns)

    if found.where("same > spare").isEmpty():
        return repeated(joined, times)
    untied = repeated(joined.where(~F.coalesce(tied, F.lit(False))), times)
    # stored with a number, so that equal rows can be told apart from here on
    equal = stored(joined.where(tied).withColumn(again, F.monotonically_increasing_id()), "equal-rows")
    place = unused(equal, "_place")
    places = ranked(equal.select(origin, words, again), [origin, words], [again], F.col(again), place, task_count(docs))
    one_more = F.when(F.col(place) < F.col(spare), 1).otherwise(0)
    numbered = equal.join(places.select(again, place), again)
    return untied.unionByName(repeated(numbered, F.col(base) + one_more))
