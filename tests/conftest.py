import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sqlsieve.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, memory="6g", app="tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def values(spark):
    """Values of Column functions over (content, path) rows, in row order."""

    def run(rows, *columns):
        rows = [r if isinstance(r, tuple) else (r, "") for r in rows]
        df = spark.createDataFrame(
            [(i, *r) for i, r in enumerate(rows)], "i int, content string, path string"
        )
        named = [c.alias(f"c{n}") for n, c in enumerate(columns)]
        out = df.repartition(4).select("i", *named).orderBy("i").collect()
        if len(columns) == 1:
            return [r[1] for r in out]
        return [tuple(r[1:]) for r in out]

    return run
