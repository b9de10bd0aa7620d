"""Each query that has SQL against it, on the small shared tables; skipped where these are not."""

from __future__ import annotations

import os
from pathlib import Path

import duckdb
import pytest

from weftline.llm.queries import ORACLE_SQL, QUERIES

DATA = Path(os.environ.get("WEFTLINE_TEST_DATA", "/root/testdata/sf0.001"))

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no shared tables")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    cur = con.execute(ORACLE_SQL[name])
    names = [c[0] for c in cur.description]
    got = QUERIES[name](spark, str(DATA))
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(*names).collect()), key=repr) == sorted(cur.fetchall(), key=repr)
