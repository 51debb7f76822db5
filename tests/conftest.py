import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from ledgerloom.session import local_session  # noqa: E402

DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return str(DATA / "sf0.001")


@pytest.fixture()
def setting(spark):
    """Change a runtime setting for one test."""
    changed = {}

    def change(key, value):
        changed.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield change
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture()
def values(spark):
    """Evaluate one expression over a list of texts."""

    def evaluate(expression, inputs, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
        rows = df.select("i", expression.alias("out")).orderBy("i").collect()
        return [r.out for r in rows]

    return evaluate
