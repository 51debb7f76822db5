"""From raw documents to packed training sequences: five stages, each one operator.

Every stage takes documents (doc_id, text, lang, source, n_chars) and, but for the last, returns
documents again.  Between stages the rows are written to the cluster's shared folder and
read back, so a lost executor repeats a scan, and each stage sees true sizes.  All stages share
the executors, whose heaps have grown to their limit after a few; the rest is for Python
workers and buffers, so texts reach the workers in small batches.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import chunks, mixing, packing, quality, simhash
from ledgerloom.session import settled, small_batches

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    """The setting stays: a stage's tasks run when its result is written."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


@in_small_batches
def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly trained classifier rejects go."""
    return quality.keep_good(docs, fit_rows=quality.FIT_ROWS)


@in_small_batches
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the document with the smallest id stays."""
    return simhash.keep_one(docs, words=4, radius=4)


@in_small_batches
def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut out of the later ones' texts."""
    cut = chunks.deduplicate(docs, least_words=20)
    return cut.withColumn("n_chars", F.length("text").cast("long"))


@in_small_batches
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; some not at all, some twice."""
    return mixing.mix(docs, weights=(3, 1, 2), share=1.5, cap=2)


@in_small_batches
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token spans of the documents and their places in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, limit=2048, end_id=1)


STAGES = [
    ("quality classifier", keep_good_quality),
    ("SimHash near-dedup", drop_near_copies),
    ("substring dedup", cut_repeated_passages),
    ("mixing to target weights", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # trained models, graph components and bin packing are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage.  A stage's tables, and its input, go once its output is written."""

    def after(count: int) -> DataFrame:
        if not count:
            return spark.read.parquet(f"{sf_dir}/documents.parquet")
        name, stage = STAGES[count - 1]
        return settled(spark, lambda: stage(spark, after(count - 1), sf_dir), name.replace(" ", "-"))

    return STAGES[-1][1](spark, after(len(STAGES) - 1), sf_dir)
