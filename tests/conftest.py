from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tradeops.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, shuffle_partitions=4, app="tradeops-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    from tradeops.workload import compare

    return compare.duck(SF_DIR)
