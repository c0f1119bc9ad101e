import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from strata.session import build_session
    s = build_session("local[8]", app_name="strata-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="strata-test-", dir="/tmp")


@pytest.fixture(autouse=True)
def _default_broadcast_limit(request):
    yield
    if "spark" in request.fixturenames:
        request.getfixturevalue("spark").conf.unset("spark.sql.autoBroadcastJoinThreshold")
