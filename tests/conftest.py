import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

SF_SMALL = os.environ.get("DRIFTWOOD_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from driftwood.session import build_session

    s = build_session(master="local[4]", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL


@pytest.fixture(scope="session")
def duck(sf):
    from oracle_check import duck as mk

    return mk(sf)
