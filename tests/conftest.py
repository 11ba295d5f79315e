import os
import sys
import tempfile

import pytest

_HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(_HERE), _HERE]

from ampliframe.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    session = local_session(
        4,
        "ampliframe-tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": warehouse,
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def work():
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp")


@pytest.fixture
def rows(spark):
    """DataFrame from tuples and a DDL schema."""

    def make(data, schema):
        return spark.createDataFrame(data, schema)

    return make
