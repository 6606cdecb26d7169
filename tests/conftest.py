from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from eventmarts.session import local_session

    session = local_session("tests", 8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("test tables are not on this machine")
    return SF
