import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("PAGEFACTS_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from pagefacts.session import local_session

    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def one(spark):
    """Evaluate an expression over one row of named strings."""

    def run(column, **values):
        names = list(values)
        schema = ", ".join(f"{n} string" for n in names)
        return spark.createDataFrame([tuple(values[n] for n in names)], schema).select(column.alias("x")).first()["x"]

    return run
