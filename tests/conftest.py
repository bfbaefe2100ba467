import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from laurel.session import build_session
    s = build_session("laurel-tests", master="local[8]", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def one(spark):
    """Value of a column expression over one row of named values."""
    def run(expr, schema="x string", row=("",)):
        return spark.createDataFrame([row], schema).select(expr.alias("v")).first()["v"]
    return run
