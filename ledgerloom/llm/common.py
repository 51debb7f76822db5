"""What several operators need: words, stored tables, ranks, graph components."""

from __future__ import annotations

import string
import sys
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom import session

# A word is a maximal run of anything but the six ASCII blanks.  ``bytes.split()``
# without arguments cuts at exactly these, which the Python side relies on.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"


def by_value(module: str) -> None:
    """Ship a module's task functions with the job: executors need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


by_value(__name__)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def lower_words(text: str | bytes | None) -> list[bytes]:
    """The lower-cased words; only A-Z are changed."""
    data = text.encode() if isinstance(text, str) else text or b""
    return data.lower().split()


def stored(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage with a table in the cluster's shared folder."""
    return session.materialize(df, label)


# Rows of a few numbers each that every executor, and the driver, can hold: some tens of MB.
HELD = 1 << 19


def beside(table: DataFrame) -> DataFrame:
    """A stored table of decisions, to be joined to rows that carry whole texts.

    Up to ``HELD`` rows it is broadcast, so that texts stay where they are; a larger one is
    left to an ordinary join, whose hot keys are split.  The result is the same.
    """
    return F.broadcast(table) if table.count() <= HELD else table


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns that can be hashed, to order rows that agree in everything else."""
    return F.xxhash64(*[c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind])


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have; Spark's names ignore case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def task_count(df: DataFrame, least: int = 8) -> int:
    """Shuffle partitions as the session sets them, never below ``least``."""
    return max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[str], salt: Column, name: str, slices: int) -> DataFrame:
    """Number the rows of each key from 0 without sorting a key in one task.

    Rows of a key are spread over ``slices`` by ``salt``; each slice is numbered by itself
    and starts where the slices before it end.  Those starts come from one small
    row per key and slice.
    """
    cut = df.withColumn("_slice", F.pmod(salt, F.lit(slices)))
    sizes = cut.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order)
    numbered = cut.withColumn("_row", F.row_number().over(inside) - 1)
    same = [numbered[k].eqNullSafe(starts[k]) for k in keys] + [numbered["_slice"] == starts["_slice"]]
    condition = same[0]
    for part in same[1:]:
        condition = condition & part
    joined = numbered.join(starts, condition, "left")
    kept = [numbered[c] for c in df.columns]
    return joined.select(*kept, (F.col("_row") + F.col("_start")).cast("long").alias(name))


def components(edges: DataFrame, limit: int = 60) -> DataFrame:
    """The smallest reachable node of every node that has an edge.

    ``edges`` has two long columns ``a`` and ``b``; the result has ``node`` and ``root``.
    Alternating large-star and small-star steps, each a minimum per node (with
    map-side combine) joined back, so that a hub is split like any other skewed join.
    """
    lo, hi = F.least("a", "b"), F.greatest("a", "b")
    links = stored(edges.where("a <> b").select(hi.alias("a"), lo.alias("b")).distinct(), "links")
    state = _state(links)
    for _ in range(limit):
        links = stored(_small_star(_large_star(links)), "links")
        state, old = _state(links), state
        if state == old:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                links.select("b", "b").distinct()
            )
    raise RuntimeError("the components did not settle")


def _state(links: DataFrame) -> tuple:
    row = links.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("hash"),
    ).first()
    return row.n, row.hash


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


class Forest:
    """Union-find over a task's items, to send a spanning forest instead of all pairs."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, item: int) -> int:
        path = []
        while (above := self.up.get(item, item)) != item:
            path.append(item)
            item = above
        for x in path:
            self.up[x] = item
        return item

    def join(self, a: int, b: int) -> bool:
        """Whether the two were apart."""
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True
