import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from skytally.session import build_session  # noqa: E402

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "skytally-tests", master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    """DataFrame of text lines."""
    return lambda *values: spark.createDataFrame([(v,) for v in values], "value STRING")


def rows(df, *order):
    """Rows as tuples, sorted unless the DataFrame's order is asked for."""
    found = [tuple(row) for row in df.collect()]
    return found if order == ("kept",) else sorted(found, key=repr)
