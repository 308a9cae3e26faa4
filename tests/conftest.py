from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from delaylab.session import local_session

    s = local_session("*", 8, "delaylab-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def scratch():
    return tempfile.mkdtemp(prefix="delaylab-test-")


@pytest.fixture(scope="session")
def flights_csv(scratch):
    from tests.flights_fixture import write_flights_csv

    return write_flights_csv(scratch)


@pytest.fixture(scope="session")
def flights(spark, flights_csv):
    from delaylab.sources.flights import read_flights

    return read_flights(spark, flights_csv)
