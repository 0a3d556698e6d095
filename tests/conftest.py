from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from suite.compare import local_session

    return local_session(os.environ.get("TEST_CPUS", "8"), app="tests")


@pytest.fixture(scope="session")
def small() -> str:
    return SMALL


@pytest.fixture(scope="session")
def duck(small):
    from suite.compare import duck as connect

    return connect(small)
