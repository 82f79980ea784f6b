import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from firmloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def evaluate(spark):
    """Evaluate column functions over literal rows: evaluate(rows, schema, **columns)."""

    def run(rows, schema, **columns):
        indexed = [(i, *row) for i, row in enumerate(rows)]
        df = spark.createDataFrame(indexed, "row_no int, " + schema)
        out = df.select("row_no", *[c.alias(n) for n, c in columns.items()]).orderBy("row_no").collect()
        names = list(columns)
        return [r[names[0]] if len(names) == 1 else tuple(r[n] for n in names) for r in out]

    return run
