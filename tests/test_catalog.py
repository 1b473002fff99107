"""Every catalogue query against its DuckDB oracle on the smallest driver tables.

The same comparison the driver runs at sf0.01 (row count, column names,
order-insensitive values); rows-only keys just have to run.
"""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry  # noqa: E402
from latewatch.plans import catalog  # noqa: E402
from latewatch.plans.fixtures import DRIVER_TABLES  # noqa: E402
from oracle_check import _rows  # noqa: E402
from conftest import SF_SMALL  # noqa: E402

QUERIES = catalog.queries()
ORACLE = catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_key_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and "pct_on_time" in df.columns


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    cols = df.columns
    got = [tuple(r) for r in df.collect()]
    if key not in ORACLE:
        assert len(got) > 0
        return
    rel = duck.sql(ORACLE[key])
    ocols = list(rel.columns)
    want = rel.fetchall()
    assert sorted(cols) == sorted(ocols)
    si = sorted(range(len(cols)), key=lambda i: cols[i])
    oi = sorted(range(len(ocols)), key=lambda i: ocols[i])
    assert _rows([tuple(r[i] for i in si) for r in got]) == _rows([tuple(r[i] for i in oi) for r in want])
