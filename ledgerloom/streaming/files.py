"""Incremental ingest of a landing folder, one micro-batch of new files at a time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom import schema as S
from ledgerloom.operators import dedupe
from ledgerloom.plans.ingest import Ingested, ingest_lines, registrations
from ledgerloom.session import materialize, scratch


def line_stream(
    spark: SparkSession, folder: str, name_glob: str | None = None, max_files: int | None = None
) -> DataFrame:
    """New text files of a folder as undecoded lines with their file of origin."""
    reader = spark.readStream
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(folder).select(
        F.col("_metadata.file_path").alias("src_file"),
        F.lit("").alias("entry"),
        F.col("value").cast("binary").alias("raw"),
        F.col("_metadata.file_block_start").alias("file_block_start"),
    )


def _lines(batch: DataFrame) -> DataFrame:
    """The lines of a micro-batch in file order; a file is never split over two of them."""
    at = F.struct("file_block_start", F.monotonically_increasing_id().alias("at"))
    return batch.select("src_file", "entry", "raw", at.alias("line_at"))


SEEN = "first long, second long, query string, batch long, period int"
HELD_DIGESTS = 1 << 19  # digests that a task compares its rows with
AUDIT = "n_rows long, n_distinct long, n_new long, n_flagged long, n_rejects long"


def _period() -> Column:
    """The period as one number, 0 for all impossible ones, so that their number is bounded."""
    possible = F.col("year").between(S.FIRST_YEAR, S.LAST_YEAR) & F.col("quarter").between(1, 4)
    return F.when(possible, F.col("year") * 10 + F.col("quarter")).otherwise(0).cast("int")


def _digested(rows: DataFrame) -> DataFrame:
    """``rows`` with 128 bits that stand for all columns; NULL is told from any value."""
    parts = [x for c in rows.columns for x in (F.col(c), F.col(c).isNull())]
    return rows.withColumns({"first": F.xxhash64(*parts), "second": F.xxhash64(F.lit(7), *parts), "period": _period()})


def unseen(rows: DataFrame, seen: DataFrame) -> DataFrame:
    """The digested ``rows`` of which ``seen`` has no equal; only the periods that the rows touch are read.

    ``rows`` is a stored table of distinct rows.  Its periods, at most four a year and one for all the
    impossible, go to the plan as partition filters.
    """
    touched = [r.period for r in rows.select("period").distinct().collect()]
    keys = ["period", "first", "second"]
    known = seen.filter(F.col("period").isin(touched)).select(keys)
    # as many tasks that each holds its share of the digests, and the rows need no sort
    tasks = max(-(-known.count() // HELD_DIGESTS), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    held = known.repartition(tasks, *keys).hint("shuffle_hash")
    return rows.repartition(tasks, *keys).join(held, keys, "left_anti")


def ingest_stream(
    stream: DataFrame,
    registry: DataFrame,
    target: str,
    checkpoint: str,
    prepare: Callable[[DataFrame, DataFrame], Ingested] = ingest_lines,
    distinct: bool = False,
) -> StreamingQuery:
    """Take everything new through the ingest of whole landings, then stop.

    Encodings, headers, layouts, numbers and flags are those of ``ingest_lines``.  The checkpoint
    remembers the files already seen.  Every micro-batch owns folders below the target, named by the
    query and the batch number, and replaces them when it is repeated; another query,
    or one whose checkpoint was lost, has folders of its own.

    With ``distinct``, rows that an earlier batch (of any query) brought are left out: digests of all rows are
    kept by period, and a batch is compared with those of its own periods.  One query at a time then.
    Each batch also leaves one row of counts, see ``read_audit``.

    The registry is made ready once for all batches; ``prepare`` gets it as ``registrations`` leaves it.
    """
    known = registrations(registry)
    if distinct:
        spark = stream.sparkSession
        spark.createDataFrame([], SEEN).write.mode("ignore").partitionBy("query", "batch", "period").parquet(f"{target}/seen")

    def write(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        query = session.sparkContext.getLocalProperty("sql.streaming.queryId")

        def folder(part: str) -> str:
            return f"{target}/{part}/query={query}/batch={number}"

        with scratch(session):
            done = prepare(_lines(batch), known)
            read, rejected, written = Observation(), Observation(), Observation()
            rows = done.rows.observe(read, F.count(F.lit(1)).alias("n"))
            # every observed table is written once: its counts come with the write
            new = _digested(materialize(dedupe.distinct_rows(rows.select(*S.EXPENSE_COLUMNS, "issue_flags")), "distinct"))
            n_distinct = new.count()
            if distinct:
                # a repeated batch must not meet its own digests
                before = session.read.schema(SEEN).parquet(f"{target}/seen").filter(~((F.col("query") == query) & (F.col("batch") == number)))
                new = materialize(unseen(new, before), "unseen")
                digests = new.select("first", "second", "period")
                digests.write.mode("overwrite").partitionBy("period").parquet(folder("seen"))
            flagged = F.count_if(F.col("issue_flags") != "").alias("flagged")
            kept = new.drop("first", "second", "period").observe(written, F.count(F.lit(1)).alias("n"), flagged)
            kept.write.mode("overwrite").parquet(folder("expense"))
            done.rejects.observe(rejected, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(folder("rejects"))
            counts = (read.get.get("n", 0), n_distinct, written.get.get("n", 0), written.get.get("flagged", 0), rejected.get.get("n", 0))
            session.createDataFrame([counts], AUDIT).coalesce(1).write.mode("overwrite").parquet(folder("audit"))

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_audit(spark: SparkSession, target: str) -> DataFrame:
    """One row per micro-batch: ``n_rows`` read, ``n_distinct`` among them, ``n_new`` written, ``n_flagged`` of these, ``n_rejects``."""
    return spark.read.parquet(f"{target}/audit")


def read_ingested(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(f"{target}/expense").drop("query", "batch")


def read_rejects(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(f"{target}/rejects").drop("query", "batch")
