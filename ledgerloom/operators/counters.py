"""Row counters that ride along with a job instead of needing one of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def observed(df: DataFrame, name: str, **extra: Column) -> tuple[DataFrame, Observation]:
    """The same rows, and a counter filled when they are next written or collected."""
    counter = Observation(name)
    counts = [F.count(F.lit(1)).alias("n_rows"), *[e.alias(k) for k, e in extra.items()]]
    return df.observe(counter, *counts), counter


def removed(before: Observation, after: Observation) -> dict[str, int]:
    """What a step between two counters took away; call it after the action."""
    n_before, n_after = before.get["n_rows"], after.get["n_rows"]
    return {"n_before": n_before, "n_after": n_after, "n_removed": n_before - n_after}
