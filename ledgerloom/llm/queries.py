"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    ann,
    chunks,
    hnsw,
    interpolation,
    mixing,
    packing,
    phrases,
    quality,
    quotes,
    simhash,
    spelling,
    whitening,
    wordpieces,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_interpolation(spark, folder):
    remainder = interpolation.id_remainder("doc_id", 7)
    return interpolation.score_documents(table(spark, folder, "documents"), held_out=remainder == 2, deleted=remainder == 3, order=2)


@query
def op2_packing(spark, folder):
    return packing.pack_documents(table(spark, folder, "documents"), limit=2048, end_id=1)


@query
def op3_wordpiece(spark, folder):
    return wordpieces.count_tokens(table(spark, folder, "documents"))


@query
def op4_weak_labels(spark, folder):
    return quality.classify(table(spark, folder, "documents"), fit_rows=quality.FIT_ROWS)


@query
def op5_hnsw(spark, folder):
    found = hnsw.near_duplicates(table(spark, folder, "embeddings"), least=0.9)
    return found.withColumnRenamed("id", "vec_id")


@query
def op6_mixing(spark, folder):
    found = mixing.copies(table(spark, folder, "documents"), weights=(3, 1, 2), share=1.5, cap=2)
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "n_copies")


@query
def op7_quotes(spark, folder):
    return quotes.link_quotes(table(spark, folder, "conversations"))


@query
def op8_simhash(spark, folder):
    found = simhash.near_duplicates(table(spark, folder, "documents"), words=4, radius=4)
    return found.select(
        F.col("id").alias("doc_id"),
        simhash.hex_of(F.col("fp")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query
def op9_adaptive_scan(spark, folder):
    rows = table(spark, folder, "embeddings")
    return ann.search(rows, rows.where("vec_id % 20 = 0"), k=20)


@query
def op10_chunks(spark, folder):
    spans = chunks.repeated_spans(table(spark, folder, "documents"), least_words=20)
    return spans.select(
        F.col("id").alias("doc_id"),
        F.col("start").cast("long").alias("start_byte"),
        F.col("end").cast("long").alias("end_byte"),
        "n_words",
        "kept_ids",
    )


@query
def op11_phrases(spark, folder):
    found = phrases.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"), size=10)
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLES["op11_phrases"] = r"""
WITH cased AS (
    SELECT row_number() OVER () AS d, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
), docs AS (
    SELECT d, doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM cased
), items AS (
    SELECT item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), begins AS (
    SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0
), windows AS (
    SELECT DISTINCT item_id, n, w[i:i + n - 1] AS words FROM begins
), places AS (
    SELECT d, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n
), found AS (
    SELECT p.d, p.i, p.n, x.item_id FROM places p JOIN windows x ON x.n = p.n AND x.words = p.w[p.i:p.i + p.n - 1]
), hit AS (
    SELECT d, count(*) AS n_hit FROM (SELECT DISTINCT d, unnest(range(i, i + n)) AS at FROM found) GROUP BY d
), named AS (
    SELECT d, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT d, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY d
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (d) LEFT JOIN named USING (d)
"""


@query
def op12_whitening(spark, folder):
    return whitening.whiten(table(spark, folder, "embeddings"), most=8, scale=1024, offset=100_000).withColumnRenamed("id", "vec_id")


@query
def op13_spelling(spark, folder):
    return spelling.group_spellings(table(spark, folder, "documents"), least_length=6, least_count=5, damage=199, ratio=5)
