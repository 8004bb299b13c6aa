from __future__ import annotations

import pytest

from tests.conftest import SF_DIR
from tradeops.workload import compare


@pytest.fixture(scope="session")
def duck_docs():
    con = compare.duck(SF_DIR)
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{SF_DIR}/{t}.parquet')")
    return con
