import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("SALESCOPE_DRIVER_MEMORY", "6g")
    from salescope.session import local_session
    s = local_session(4, shuffle_partitions=4, app="salescope-tests")
    yield s
    s.stop()
