import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from eventfeat.session import build_session

    s = build_session("local[4]", app="eventfeat-tests", shuffle_partitions=4, extra={"spark.driver.memory": "6g"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_dir():
    return SMALL
