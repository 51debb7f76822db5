"""Substring search by a stored index of trigrams.

Every three consecutive characters of an entity's id and of its lower-case name lead to that entity.  A search intersects the
lists of its own trigrams and compares only the entities that all of them name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import filters
from ledgerloom.plans import serving
from ledgerloom.session import materialize

GRAM = 3
BUCKETS = 64
# entities named one by one in the filter of the directory; more are joined
NAMED = 1000
# lists read for a search, the rarest ones; the comparison afterwards decides
LISTS = 6
FIELDS = {"id": "entity_id", "name": "entity_name"}


def _grams(column: str) -> Column:
    """The distinct trigrams of a text, none for NULL and for shorter ones."""
    folded = F.lower(column)
    places = F.sequence(F.lit(1), F.length(folded) - (GRAM - 1))
    long = F.length(folded) >= GRAM
    return F.when(long, F.array_distinct(F.transform(places, lambda at: F.substr(folded, at, F.lit(GRAM)))))


def _bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def _term_grams(term: str) -> list[str]:
    return sorted({term[i : i + GRAM] for i in range(len(term) - GRAM + 1)})


def postings(directory: DataFrame) -> DataFrame:
    """(field, gram, entity_id), once for every trigram of a field."""
    fields = [F.struct(F.lit(n).alias("field"), _grams(c).alias("grams")) for n, c in FIELDS.items()]
    listed = directory.select("entity_id", F.inline(F.array(*fields)))
    return listed.select("field", F.explode("grams").alias("gram"), "entity_id").distinct()


def build(directory: DataFrame, place: str) -> None:
    """Store a directory (with ``has_data``) sorted by id, the lists of its trigrams and their lengths, below ``place``.

    Lists are spread over folders by a hash of the trigram and sorted within their files, so a search opens few folders and of
    their files few row groups.  A list too long for one task is split.
    """
    directory.repartitionByRange("entity_id").sortWithinPartitions("entity_id").write.mode("overwrite").parquet(
        f"{place}/directory"
    )
    stored = read_directory(directory.sparkSession, place)
    spread = postings(stored).withColumn("bucket", _bucket(F.col("gram"))).hint("rebalance", "bucket")
    spread.sortWithinPartitions("bucket", "field", "gram").write.mode("overwrite").partitionBy("bucket").parquet(
        f"{place}/postings"
    )
    lists = directory.sparkSession.read.schema(_POSTINGS).parquet(f"{place}/postings")
    counted = lists.groupBy("bucket", "field", "gram").agg(F.count(F.lit(1)).alias("n"))
    counted.hint("rebalance", "bucket").sortWithinPartitions("bucket", "field", "gram").write.mode("overwrite").partitionBy(
        "bucket"
    ).parquet(f"{place}/lengths")


_POSTINGS = "field string, gram string, entity_id string, bucket int"
_LENGTHS = "field string, gram string, n long, bucket int"


def read_directory(spark: SparkSession, place: str) -> DataFrame:
    return spark.read.parquet(f"{place}/directory")


def _of_grams(df: DataFrame, field: str, grams: list[str]) -> DataFrame:
    """The rows of some trigrams: folders by their hashes, row groups by field and trigram."""
    buckets = [_bucket(F.lit(g)) for g in grams]  # constants to the planner, so folders are chosen by them
    return df.filter(F.col("bucket").isin(buckets) & (F.col("field") == field) & F.col("gram").isin(grams))


def candidates(spark: SparkSession, place: str, field: str, term: str) -> DataFrame | None:
    """Ids of a superset of the entities whose field contains a term; None where the term has no trigram.

    One trigram that no entity has ends the search.  Of the others the rarest are intersected, by counting.
    """
    grams = _term_grams(term)
    if not grams:
        return None
    lengths = spark.read.schema(_LENGTHS).parquet(f"{place}/lengths")
    known = _of_grams(lengths, field, grams).select("gram", "n").collect()
    lists = spark.read.schema(_POSTINGS).parquet(f"{place}/postings")
    if len(known) < len(grams):
        return lists.select("entity_id").filter(F.lit(False))
    rarest = [r.gram for r in sorted(known, key=lambda r: (r.n, r.gram))[:LISTS]]
    counted = _of_grams(lists, field, rarest).groupBy("entity_id").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") == len(rarest)).select("entity_id")


def hits(spark: SparkSession, place: str, search: str) -> DataFrame:
    """The entities that ``filters.matches_search`` finds by a literal text, without reading the others' lists.

    The id side looks for the digits of the search, the name side for its text.  A side of one or two
    characters has no trigrams: nearly every row may match then, and the directory is scanned.
    """
    directory = read_directory(spark, place)
    digits = "".join(ch for ch in search if ch in "0123456789")
    sides = [candidates(spark, place, "name", search.lower())]
    if digits:
        sides.append(candidates(spark, place, "id", digits))
    matching = filters.matches_search(search)
    if any(side is None for side in sides):
        return directory.filter(matching)
    found = sides[0]
    for side in sides[1:]:
        found = found.union(side)
    found = materialize(found.distinct(), "candidates")
    named = [r.entity_id for r in found.limit(NAMED + 1).collect()]
    if len(named) <= NAMED:
        named_ids = F.col("entity_id").isin([n for n in named if n is not None])
        missing = F.col("entity_id").isNull() if None in named else F.lit(False)
        return directory.filter(named_ids | missing).filter(matching)
    same = directory["entity_id"].eqNullSafe(found["entity_id"])
    return directory.join(found, same, "left_semi").filter(matching)


def search_entities(spark: SparkSession, place: str, page: int = 1, limit: int = 20, search: str | None = None) -> DataFrame:
    """One page as ``serving.search_entities`` gives it, from the stored index."""
    found = hits(spark, place, search) if search else read_directory(spark, place)
    return serving.search_entities(found, page, limit)
