"""Spelling variants: words one edit apart, found by dense prefix-suffix tiling.

Two words differ by one inserted, deleted or replaced code point exactly if their common prefix and
common suffix together reach the longer length less one.  Words are rows of padded code-point
matrices, one from the front and one from the back; a tile compares all words of one block with all of
another, a column of code points at a time.

Which blocks meet: half of the longer length less one, rounded up, must be common in front or at the back.
So a bin holds the words that share that many code points there, for each longer length, and every
pair one edit apart meets in the bin of its prefix or else in that of its suffix.  A bin of
more than ``PART`` words is cut into parts, and each pair of parts is a tile, so no task holds a whole bin.

Counting is done by Spark's own functions, with map-side combine.

Nulls and edges: a null or empty text has no words.  A null id counts as an empty one where ids pick what is
damaged; rows that repeat an id are counted each.  Ties between forms go to the first in code-point
order.  An empty table, or one without words often enough, gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import by_value, lower_ascii, stored, task_count

by_value(__name__)

PART = 512  # words of a bin that are one side of a tile
RUN_GAPS = r"[^A-Za-zÀ-ÿ]+"


def word_counts(
    docs: DataFrame, least_length: int = 6, least_count: int = 5, damage: int | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``word`` and ``n`` of all words long and frequent enough.

    With ``damage``, a word loses one code point where that number divides the CRC of ``<id>:<word>``:
    the one at CRC modulo length.
    """
    runs = F.explode(F.split(F.coalesce(F.col(text_col).cast("string"), F.lit("")), RUN_GAPS))
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), runs.alias("run"))
    rows = rows.where(F.length("run") >= least_length)  # damage only shortens
    word = F.when(F.lower("run") == F.col("run"), F.col("run")).otherwise(lower_ascii(F.col("run")))
    rows = rows.select("id", word.alias("word"))
    if damage:
        rows = rows.withColumn("crc", F.crc32(F.concat_ws(":", "id", "word")))
        rows = rows.select(_damaged(F.col("word"), F.col("crc"), damage).alias("word")).where(F.length("word") >= least_length)
    return rows.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def _damaged(word: Column, crc: Column, damage: int) -> Column:
    at = (crc % F.length(word)).cast("int")
    cut = F.concat(F.substr(word, F.lit(1), at), F.substr(word, at + 2))
    return F.when(crc % damage == 0, cut).otherwise(word)


def code_points(words: list[str], width: int, pad: int) -> np.ndarray:
    """A row of ``width`` code points for every word, padded behind its end."""
    table = np.array(words, f"U{width}").view(np.uint32).reshape(len(words), width).copy()
    table[table == 0] = pad
    return table


def common(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For all pairs of rows the number of code points that agree before the first that does not."""
    alive = np.ones((len(left), len(right)), bool)
    found = np.zeros(alive.shape, np.int16)
    for a, b in zip(left.T, right.T, strict=True):
        alive &= a[:, None] == b[None, :]
        if not alive.any():
            break
        found += alive
    return found


def tile(left: list[str], right: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Whether each pair of words is one edit apart, and the length of the common prefixes.

    Words must be different; the pads of the two sides differ, so a word's end matches nothing.
    """
    width = max(map(len, [*left, *right]))
    front = common(code_points(left, width, 0x110000), code_points(right, width, 0x110001))
    back = common(
        code_points([w[::-1] for w in left], width, 0x110000), code_points([w[::-1] for w in right], width, 0x110001)
    )
    sizes, others = np.array([*map(len, left)]), np.array([*map(len, right)])
    longer = np.maximum(sizes[:, None], others[None, :])
    shorter = np.minimum(sizes[:, None], others[None, :])
    return (longer - shorter <= 1) & (front + back >= longer - 1), front


def _tile_links(words: list[str], parts: list[int], one: int, two: int, longer: int, in_front: bool) -> list[tuple[int, int]]:
    left = [i for i, p in enumerate(parts) if p == one]
    right = [i for i, p in enumerate(parts) if p == two]
    if not left or not right:
        return []
    near, front = tile([words[i] for i in left], [words[i] for i in right])
    sizes = np.array([*map(len, words)])
    a, b = np.array(left), np.array(right)
    near &= np.maximum(sizes[a][:, None], sizes[b][None, :]) == longer  # the others have a bin of their own
    if one == two:
        near &= a[:, None] < b[None, :]
    if not in_front:
        near &= front < longer // 2  # else it was met by its prefix
    rows, columns = np.nonzero(near)
    return list(zip(a[rows].tolist(), b[columns].tolist(), strict=True))


def links(words: DataFrame, part: int = PART) -> DataFrame:
    """``word``, ``n``, ``near``, ``near_n``: both directions of every pair one edit apart."""
    size, keys = F.length("word"), []
    for longer in (size, size + 1):
        half = F.floor(longer / 2).cast("int")  # of longer - 1, rounded up
        keys.append(F.struct(longer.alias("longer"), F.lit(True).alias("front"), F.substr("word", F.lit(1), half).alias("key")))
        keys.append(F.struct(longer.alias("longer"), F.lit(False).alias("front"), F.substr("word", size - half + 1).alias("key")))
    binned = words.select("word", "n", F.explode(F.array(*keys)).alias("bin")).select("word", "n", "bin.*")
    bins = ["longer", "front", "key"]
    # words shorter than the longer length meet only words of that length
    full = F.count_if(F.length("word") == F.col("longer"))
    sizes = binned.groupBy(*bins).agg(F.count(F.lit(1)).alias("of"), full.alias("full")).where("of > 1 and full > 0")
    dealt = binned.join(sizes.drop("full"), bins).withColumn("parts", F.ceil(F.col("of") / part).cast("int"))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    pairs = pairs.select("word", "n", *bins, "part", F.least("part", "other").alias("one"), F.greatest("part", "other").alias("two"))
    tiles = [*bins, "one", "two"]
    # little data, much work: as many tasks as the session has partitions, whatever its size
    groups = (
        pairs.repartition(task_count(words), *tiles)
        .groupBy(*tiles)
        .agg(F.collect_list(F.struct("word", "n", "part")).alias("m"))
        .select("longer", "front", "one", "two", F.col("m.word").alias("words"), F.col("m.n").alias("counts"), F.col("m.part").alias("parts"))
    )

    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                own, n = row["words"], row["counts"]
                for i, j in _tile_links(own, row["parts"], row["one"], row["two"], row["longer"], row["front"]):
                    out += [(own[i], n[i], own[j], n[j]), (own[j], n[j], own[i], n[i])]
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
            columns = [pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "n", "near", "near_n"])

    return groups.mapInArrow(run, "word string, n long, near string, near_n long")


def roots(forms: DataFrame, limit: int = 40) -> DataFrame:
    """``word`` and ``root``, the last of the forms that follow one another.

    A form is more frequent than its word, so there are no circles; each step doubles the way.
    """
    state = stored(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(limit):
        further = state.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        moved = state.join(further, "root", "left")
        moved = stored(moved.select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        state = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return state
    raise RuntimeError("the forms did not end")


def variants(words: DataFrame, ratio: int = 5, part: int = PART) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` for the words and counts given.

    The form of a word is the most frequent word one edit away, if that is ``ratio`` times as frequent.
    """
    words = stored(words.select("word", "n"), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    near = links(words, part).groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    chosen = -F.col("best.less") >= ratio * F.col("n")
    near = near.select(
        "word", "n_near", F.when(chosen, F.col("best.near")).alias("form"), F.when(chosen, -F.col("best.less")).alias("form_n")
    )
    near = stored(near, "near-words")
    ends = roots(near.where("form is not null"))
    return (
        words.join(near, "word", "left")
        .join(ends, "word", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
    )


def group_spellings(
    docs: DataFrame, least_length: int = 6, least_count: int = 5, damage: int | None = None, ratio: int = 5, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The variants among the words of whole texts; see ``word_counts`` and ``variants``."""
    return variants(word_counts(docs, least_length, least_count, damage, id_col, text_col), ratio)
