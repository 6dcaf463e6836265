"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry_module
from weftline.plans import TABLE_NAMES

DATA = "/root/testdata/sf0.001"
QUERIES, SQL = entry_module.queries(), entry_module.oracle_sql()
NEEDS_MORE_ROWS = {"ml_01_null_split_samples": "/root/testdata/sf0.01"}


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    return [plain(x) for x in v] if isinstance(v, (list, tuple)) else repr(v)


def connect(path):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLE_NAMES:
        con.execute(f"create view {t} as select * from '{path}/{t}.parquet'")
    return con


def test_sql_has_only_registered_names():
    assert set(SQL) <= set(QUERIES)


def test_entry_runs(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, name):
    path = NEEDS_MORE_ROWS.get(name, DATA)
    df = QUERIES[name](spark, path)
    cur = connect(path).execute(SQL[name])
    names = [d[0] for d in cur.description]
    order = sorted(df.columns)
    assert order == sorted(names)
    want = sorted(str([plain(r[names.index(c)]) for c in order]) for r in cur.fetchall())
    assert sorted(str([plain(r[c]) for c in order]) for r in df.collect()) == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0
