"""Every registered query against its DuckDB oracle (row count, columns, value hash) on the smallest data."""

import hashlib
import math
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E

from conftest import SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 6))
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)


def test_queries_without_oracle_run(spark):
    for key in sorted(set(E.queries()) - set(E.oracle_sql())):
        assert E.queries()[key](spark, SMALL).count() > 0, key


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "matched_market" in df.columns


def test_entry_without_the_optional_operators():
    """A library that only they need is missing: the other queries are all there."""
    code = ("import sys; sys.modules['xxhash'] = None; import __spark_entry__ as E; from semjoin.plans import registry; "
            "assert set(E.queries()) == set(registry.QUERIES) and set(E.oracle_sql()) == set(registry.ORACLES)")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
