"""Each registered query against its SQL, on the smallest shared tables; skipped where these are not."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from weftline.plans import catalogue, graph_queries  # noqa: F401

DATA = Path(os.environ.get("WEFTLINE_TEST_DATA", "/root/testdata/sf0.001"))
ROOT = Path(__file__).resolve().parent.parent
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no shared tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    got = catalogue.QUERIES[name](spark, str(DATA))
    rows = sorted((tuple(r) for r in got.collect()), key=repr)
    if name not in catalogue.ORACLE_SQL:
        assert rows
        return
    cur = duck.execute(catalogue.ORACLE_SQL[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(got.columns)
    at = [names.index(c) for c in got.columns]
    assert rows == sorted((tuple(r[k] for k in at) for r in cur.fetchall()), key=repr)


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["relation", "edges", "sources", "targets"]


def test_without_the_training_data_part(tmp_path):
    for name in ("weftline", "__spark_entry__.py"):
        source = ROOT / name
        shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__")) if source.is_dir() else shutil.copy(source, tmp_path / name)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') or n == 'pipeline' for n in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
