import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillwork import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    made = session.build(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__driver__memory="4g", spark__checkpoint__dir=tempfile.mkdtemp(prefix="tests-"),
    )
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()


@pytest.fixture
def rows():
    """Rows of a table as sorted tuples."""
    def read(df):
        return sorted((tuple(r) for r in df.collect()),
                      key=lambda row: [(v is not None, str(v)) for v in row])
    return read
