import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from recoloom.session import local_session
    s = local_session(os.environ.get("TEST_CORES", "*"), 8, app="recoloom-tests")
    yield s
    s.stop()
