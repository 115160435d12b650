import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from entityloom.session import local_session  # noqa: E402


# Started on import, since test modules build columns at their top level.
SESSION = local_session(8, shuffle_partitions=4)
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    yield SESSION
    SESSION.stop()


@pytest.fixture
def rows(spark):
    """Evaluate columns on a one-column text frame and give the values as tuples."""

    def run(values, *columns):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, x string")
        out = df.select("i", *[c.alias(f"c{k}") for k, c in enumerate(columns)]).orderBy("i").collect()
        return [tuple(r)[1] if len(columns) == 1 else tuple(r)[1:] for r in out]

    return run
