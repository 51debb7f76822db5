"""Quotation linking: conversations in reply order, without the quotes, by DataFrame operations only.

A line's quote level is the number of ``>`` before it; lines of one level in a row are a passage.
Passages of level 1 and deeper, their paragraphs and their lines are normalised (case, blanks) and
hashed, and joined to the first earlier message of the conversation that holds them in its
own words.  A message's parent is the original it quotes most at the outermost level found; a
message that quotes nothing found continues the message before it.

Reply order puts every reply after the message it answers and before that message's continuation.
It is the preorder of the reply tree, found by pointer jumping: each round is one join on
(conversation, number), so that a long conversation is no single task.  Conversations without
links are in the order of their turns.

Nulls and edges: a null text is empty.  Equal rows are one message; different rows of one turn
are ordered by role and text.  Rows without a conversation or a turn are conversations of their own.
Quotes that nothing matches are removed all the same.  An empty table gives an empty result, and other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.common import stored

LEVEL = r"^((?:[ \t]*>)+)[ \t]?"
QUOTES = r"(?m)^[ \t]*>"
# a line that names the author of the quote below it
CREDIT = r"(?i)(wrote|writes|schrieb|a écrit|escribió)\s*:\s*$"
TURNS = 1024  # turns that are numbered together, and answers to one message that are


def normalised(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def units(text: Column) -> Column:
    """The text, its paragraphs and its lines, however short: (hash, chars), each once."""
    parts = F.concat(F.array(text), F.split(text, r"\n\s*\n"), F.split(text, r"\n"))
    clean = F.filter(F.array_distinct(F.transform(parts, normalised)), lambda x: F.length(x) > 0)
    return F.transform(clean, lambda x: F.struct(F.xxhash64(x).alias("hash"), F.length(x).alias("chars")))


def numbered(messages: DataFrame) -> DataFrame:
    """``n``: a message's number within its conversation, from 0; turns are numbered in blocks."""
    cut = messages.withColumn("_block", F.floor(F.col("turn") / TURNS))
    sizes = cut.groupBy("conv", "_block").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy("conv").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("conv", "_block", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("conv", "_block").orderBy("turn", "role", "text")
    placed = cut.withColumn("_row", F.row_number().over(inside) - 1).join(starts, ["conv", "_block"])
    return placed.withColumn("n", (F.col("_row") + F.col("_start")).cast("long")).drop("_block", "_row", "_start")


def passages(messages: DataFrame) -> DataFrame:
    """conv, n, passage, level and body of the passages of messages that quote."""
    lines = messages.select("conv", "n", F.posexplode(F.split("text", "\n")).alias("line", "raw"))
    prefix = F.regexp_extract("raw", LEVEL, 1)
    lines = lines.select(
        "conv", "n", "line", F.length(F.regexp_replace(prefix, r"[ \t]", "")).alias("level"), F.regexp_replace("raw", LEVEL, "").alias("body")
    )
    order = Window.partitionBy("conv", "n").orderBy("line")
    credit = (F.col("level") == 0) & F.col("body").rlike(CREDIT) & (F.lead("level").over(order) > 0)
    lines = lines.withColumn("credit", F.coalesce(credit, F.lit(False))).where("not credit")
    begins = F.when(F.lag("level").over(order) == F.col("level"), 0).otherwise(1)
    lines = lines.withColumn("begins", begins).withColumn("passage", F.sum("begins").over(order))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line", "body"))), lambda x: x["body"]), "\n")
    return lines.groupBy("conv", "n", "passage", "level").agg(joined.alias("body"))


def _own_words(quoted: DataFrame) -> DataFrame:
    own = F.when(F.col("level") == 0, F.struct("passage", "body"))
    return quoted.groupBy("conv", "n").agg(
        F.trim(F.array_join(F.transform(F.sort_array(F.collect_list(own)), lambda x: x["body"]), "\n")).alias("own"),
        F.count_if(F.col("level") > 0).alias("n_quotes"),
    )


def parents(bodies: DataFrame, quoted: DataFrame) -> DataFrame:
    """conv, n, parent (number of the message answered) and n_linked of messages with a found quote."""
    talking = quoted.select("conv").distinct()
    held = bodies.join(talking, "conv", "left_semi").select("conv", "n", F.explode(units(F.col("own"))).alias("unit"))
    first = held.groupBy("conv", F.col("unit.hash").alias("hash")).agg(F.min("n").alias("parent"))
    asked = quoted.where("level > 0").select("conv", "n", "passage", "level", F.explode(units(F.col("body"))).alias("unit"))
    asked = asked.select("conv", "n", "passage", "level", "unit.hash", "unit.chars")
    found = asked.join(first, ["conv", "hash"]).where("parent < n")
    weight = found.groupBy("conv", "n", "level", "parent").agg(F.sum("chars").alias("chars"))
    best = weight.groupBy("conv", "n").agg(
        F.max(F.struct((-F.col("level")).alias("outer"), "chars", (-F.col("parent")).alias("early"))).alias("best")
    )
    linked = found.groupBy("conv", "n").agg(F.countDistinct("passage").alias("n_linked"))
    return best.join(linked, ["conv", "n"]).select("conv", "n", (-F.col("best.early")).alias("parent"), "n_linked")


def _jump(nodes: DataFrame, pointer: str, weight: str | None, label: str) -> DataFrame:
    """Follow ``pointer`` to its end by doubling; weights along the way are added up."""
    while True:
        ahead = nodes.select(
            "conv", F.col("n").alias(pointer), F.col(pointer).alias("_next"), *([F.col(weight).alias("_more")] if weight else [])
        )
        moved = nodes.join(ahead, ["conv", pointer], "left")
        ends = F.col("_next") if weight else F.coalesce("_next", pointer)
        changes = {"_new": ends}
        if weight:
            changes[weight] = F.col(weight) + F.coalesce("_more", F.lit(0))
        moved = moved.withColumns(changes).withColumn("_moved", ~F.col("_new").eqNullSafe(F.col(pointer)))
        moved = stored(moved.drop(pointer, "_next", "_more").withColumnRenamed("_new", pointer), label)
        still = not moved.where("_moved").isEmpty()
        nodes = moved.drop("_moved")
        if not still:
            return nodes


def _siblings(tree: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The tree with ``beside``, a message's next sibling, and the first ``child`` of every message that has one.

    Answers come first, in their order, and what continues the message comes last.  The answers to one message are
    looked at in slices of their numbers, so that a message with a million answers is no single task.
    """
    last = F.lit((1 << 62)).cast("long")
    cut = tree.withColumn("slice", F.when(F.col("answers"), F.floor(F.col("n") / TURNS)).otherwise(last))
    slices = cut.where("above is not null").groupBy("conv", "above", "slice").agg(F.min("n").alias("first"))
    below = slices.groupBy("conv", F.col("above").alias("n")).agg(F.min_by("first", "slice").alias("child"))
    later = F.lead("first").over(Window.partitionBy("conv", "above").orderBy("slice"))
    slices = slices.select("conv", "above", "slice", later.alias("later"))
    inside = Window.partitionBy("conv", "above", "slice").orderBy("n")
    within = F.when(F.col("above").isNotNull(), F.lead("n").over(inside))
    joined = cut.withColumn("within", within).join(slices, ["conv", "above", "slice"], "left")
    return joined.withColumn("beside", F.coalesce("within", "later")).drop("slice", "within", "later"), below


def reply_order(messages: DataFrame) -> DataFrame:
    """conv, n and position (from 1) in the preorder of the reply tree.

    ``messages``: conv, n and parent, null where a message continues the one before it.
    """
    answers = F.col("parent").isNotNull()
    tree = messages.select(
        "conv", "n", F.when(answers, F.col("parent")).otherwise(F.when(F.col("n") > 0, F.col("n") - 1)).alias("above"), answers.alias("answers")
    )
    tree, below = _siblings(tree)
    tree = stored(tree.join(below, ["conv", "n"], "left"), "tree")
    # last children hand on to the nearest one above that has another beside it
    climb = tree.select("conv", "n", F.when(F.col("beside").isNotNull() | F.col("above").isNull(), F.col("n")).otherwise(F.col("above")).alias("up"))
    climb = _jump(climb, "up", None, "climb")
    tops = tree.select("conv", F.col("n").alias("up"), F.col("beside").alias("after"))
    turns = climb.join(tops, ["conv", "up"]).select("conv", "n", "after")
    chain = tree.join(turns, ["conv", "n"]).select("conv", "n", F.coalesce("child", "after").alias("follows"))
    chain = stored(chain.withColumn("behind", F.when(F.col("follows").isNotNull(), 1).otherwise(0).cast("long")), "chain")
    chain = _jump(chain, "follows", "behind", "rank")
    sizes = chain.groupBy("conv").agg(F.count(F.lit(1)).alias("size"))
    return chain.join(sizes, "conv").select("conv", "n", (F.col("size") - F.col("behind")).alias("position"))


def link_quotes(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """conv_id, turn, role, position, parent_turn, n_quotes, n_linked and text (own words only)."""
    rows = df.select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        F.col(role_col).cast("string").alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).distinct()
    messages = stored(numbered(rows.where("conv is not null and turn is not null")), "messages")
    quoting = F.col("text").rlike(QUOTES)
    quoted = stored(passages(messages.where(quoting)), "passages")
    spoken = stored(_own_words(quoted), "own-words")
    plain = messages.where(~quoting).select("conv", "n", F.col("text").alias("own"))
    links = stored(parents(plain.unionByName(spoken.select("conv", "n", "own")), quoted), "parents")
    tied = links.select("conv").distinct()
    tangled = messages.join(tied, "conv", "left_semi").join(links, ["conv", "n"], "left").select("conv", "n", "parent")
    order = reply_order(tangled) if not links.isEmpty() else messages.select("conv", "n", F.lit(0).cast("long").alias("position")).limit(0)
    origin = messages.select("conv", F.col("n").alias("parent"), F.col("turn").alias("parent_turn"))
    linked = links.join(origin, ["conv", "parent"]).select("conv", "n", "parent_turn", "n_linked")
    result = (
        messages.join(spoken, ["conv", "n"], "left")
        .join(linked, ["conv", "n"], "left")
        .join(order, ["conv", "n"], "left")
        .select(
            F.col("conv").alias("conv_id"), "turn", "role", F.coalesce("position", F.col("n") + 1).alias("position"), "parent_turn",
            F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
            F.coalesce("own", "text").alias("text"),
        )
    )
    alone = rows.where("conv is null or turn is null")
    one = F.lit(1).cast("long")
    without = F.trim(F.array_join(F.filter(F.split("text", "\n"), lambda x: ~x.rlike(LEVEL)), "\n"))
    alone = alone.select(
        F.col("conv").alias("conv_id"), "turn", "role", one.alias("position"), F.lit(None).cast("long").alias("parent_turn"),
        F.when(quoting, 1).otherwise(0).cast("long").alias("n_quotes"), F.lit(0).cast("long").alias("n_linked"),
        F.when(quoting, without).otherwise(F.col("text")).alias("text"),
    )
    return result.unionByName(alone)
