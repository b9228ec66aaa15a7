import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from courtside.session import local_session
    s = local_session("4", shuffle_partitions=8, app_name="courtside-tests")
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    """A fresh folder per test (never reused, never cleaned by us)."""
    return tempfile.mkdtemp(prefix="courtside-test-")
