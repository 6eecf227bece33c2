import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from touchline import get_session

    shared = f"file://{tmp_path_factory.mktemp('shared')}"

    session = get_session(
        "tests", "local[8]", **{
            "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g", "spark.checkpoint.dir": shared,
        }
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Build a DataFrame from tuples and a DDL schema."""
    return lambda data, schema: spark.createDataFrame(data, schema)


def values(df, *cols):
    """Sorted tuples of a result."""
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
