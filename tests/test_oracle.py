"""Every registered query against its DuckDB oracle SQL on sf0.001."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF001

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

# the optional subpackage has its own tests
QUERIES = {n: q for n, q in E.queries().items() if not q.__module__.startswith("crowdscope.llm")}
ORACLE = {n: sql for n, sql in E.oracle_sql().items() if n in QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def _norm(v):
    if v is None:
        return ("~null",)
    if isinstance(v, float):
        return ("nan",) if math.isnan(v) else v      # bit-for-bit: both engines compute the same doubles
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_an_oracle_or_is_listed_rows_only():
    rows_only = {"profile_json", "profile_report"}
    assert set(QUERIES) - set(ORACLE) == rows_only


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    got = [tuple(r) for r in df.collect()]
    res = con.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(res.columns)
    assert _rows(df.columns, got) == _rows(res.columns, res.fetchall())
