import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) rows."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture()
def clashing():
    """The same table with columns named like the operators' own."""

    def widen(df):
        from pyspark.sql import functions as F

        names = ("id", "fp", "key", "n", "size", "length", "start", "end", "rank", "component", "score", "role", "split", "_spans", "v")
        return df.select("*", *[F.lit("x").alias(n) for n in names if n not in df.columns])

    return widen
