from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from urbanlens.session import build_session, release_scratch

    s = build_session(master="local[*]", shuffle_partitions=8)
    yield s
    release_scratch(s)
    s.stop()


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF_SMALL):
        pytest.skip("test tables not present")
    return SF_SMALL


@pytest.fixture(scope="session")
def duck(sf):
    import duckdb

    from urbanlens.sources.tables import TABLES, table_path

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf, t)}')")
    return con
