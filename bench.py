"""Time the headline queries and print one JSON line.

Every query is run once to warm up and then timed; results go to a sink that
drops them, so all rows are computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F

from bindings import views as V
from bindings.queries import QUERIES
from ledgerloom import schema as S
from ledgerloom.functions import numbers
from ledgerloom.plans import aggregate, enrich, validate
from ledgerloom.session import fresh_folder, local_session, materialize, tune
from ledgerloom.sinks import tables
from ledgerloom.sources import delimited

HEADLINE = [
    "br_number_parse",
    "text_clean",
    "cnpj_check_digits",
    "issue_flags",
    "validity_columns",
    "quality_report",
    "flag_histogram",
    "union_distinct_sort",
    "keep_first",
    "load_accept",
    "upsert_by_key",
    "enrich_left",
    "match_coverage",
    "rank_aggregate",
    "describe_groups",
    "describe_totals",
    "top_growth",
    "expense_by_region",
    "count_above_mean",
    "entity_directory",
    "search_page",
    "entity_history",
    "dashboard_regions",
    "dashboard_stats",
    "ledger_filter_lookup",
    "zip_source",
    "encoding_fallback",
    "csv_roundtrip",
    "ingest_ledger",
]
REPEATS = 3


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(run) -> float:
    run()
    seconds = []
    for _ in range(REPEATS):
        start = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 4)


def throughput(spark, folder: str) -> dict[str, int]:
    """Rows per second of the stages for which logged times exist.

    The rows are the ledger's expenses: one per line item, as delimited text.
    """
    lines = V.ledger(spark, folder).select(
        "registration", "description", "amount", "year", "quarter"
    )
    rows = lines.select(
        F.lpad("registration", 14, "0").alias("entity_id"),
        F.col("description").alias("entity_name"),
        F.col("quarter").cast("string").alias("quarter"),
        F.col("year").cast("string").alias("year"),
        F.translate("amount", ",", ".").alias("amount"),
    )
    source = fresh_folder(spark, "bench-text")
    tables.write_delimited(rows, source, S.EXPENSE_COLUMNS)
    n = rows.count()

    def read():
        return delimited.read_delimited(spark, source, S.EXPENSE_COLUMNS)

    def typed():
        return read().withColumns(
            {
                "amount": numbers.to_decimal("amount"),
                "year": numbers.to_whole("year"),
                "quarter": numbers.to_whole("quarter"),
            }
        )

    stored = materialize(typed(), "bench-rows")
    registry = V.registry(spark, folder)
    enriched = materialize(enrich.enrich(stored, registry), "bench-enriched")

    def written() -> None:
        tables.write_delimited(validate.validate(typed()), fresh_folder(spark, "bench-out"))

    stages = {
        "read_text": lambda: drain(read()),
        "validate": lambda: drain(validate.validate(stored)),
        "read_validate_write_text": written,
        "enrich": lambda: drain(enrich.enrich(stored, registry)),
        "aggregate_and_rank": lambda: drain(aggregate.aggregate_rank(enriched)),
    }
    return {name: round(n / timed(run)) for name, run in stages.items()}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = tune(local_session(cores, "bench"))
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {name: timed(lambda run=QUERIES[name]: drain(run(spark, folder))) for name in HEADLINE}
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "rows_per_second": throughput(spark, folder),
        "sf": Path(folder).name.removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
