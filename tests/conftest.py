import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from marketlake.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=8, driver_memory="8g")
    yield s
    s.stop()
