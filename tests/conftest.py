import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidewater.session import build_session
    session = build_session(master="local[4]", shuffle_partitions=8, app="tidewater-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    from tools.check_oracle import duck as connect
    return connect(SMALL)
