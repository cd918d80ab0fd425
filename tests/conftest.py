import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from stormcab.session import build_session
    shared = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    s = build_session("local[*]", app_name="stormcab-tests", shuffle_partitions=8, extra={"spark.checkpoint.dir": shared})
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
