import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from roadspan.session import local_session

    return local_session(8, **{"spark.sql.shuffle.partitions": "4"})


@pytest.fixture(scope="session")
def duck():
    from compare import connect

    return connect(SMALL)


@pytest.fixture(params=[None, "7"], ids=["plain", "sliced"])
def slicing(request, spark):
    """Run a test with plain windows and with the time axis cut into small slices."""
    key = "spark.roadspan.rowsPerSlice"
    if request.param:
        spark.conf.set(key, request.param)
    yield request.param
    spark.conf.unset(key)
