import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tablewright.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("*", shuffle_partitions=8, memory="8g")


@pytest.fixture
def frame(spark):
    """Short hand-written tables: ``frame("a double, b string", (1.0, "x"), ...)``."""
    return lambda schema, *rows: spark.createDataFrame(list(rows), schema)
