"""Every registered query against its SQL on the smallest tables, outside the optional subpackage."""

import datetime
import decimal
import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from evidentia.plans import QUERIES, SQL
from evidentia.tables import INPUTS

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in INPUTS:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, datetime.datetime) and v.time() == datetime.time(0):
        return v.date()
    return v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    assert rows
    if name in SQL:
        rel = oracle.sql(SQL[name])
        assert sorted(rel.columns) == cols
        want = sorted((tuple(plain(dict(zip(rel.columns, r))[c]) for c in cols) for r in rel.fetchall()), key=repr)
        assert rows == want


def test_entry():
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_without_optional_parts(tmp_path):
    """Without the optional subpackage, its tests and the pipeline, the entry imports and has all other queries."""
    root = Path(__file__).resolve().parent.parent
    shutil.copytree(root / "evidentia", tmp_path / "evidentia", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    (tmp_path / "evidentia" / "llm" / "__pycache__").mkdir(parents=True)  # a folder may be left over
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, check=True)
    assert done.stdout.split() == [str(len(QUERIES)), str(len(SQL))]
