"""The registered queries against their DuckDB SQL, and that they write nothing but scratch tables."""

import duckdb
import pytest

from latewatch.llm import queries
from .conftest import SF


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    found = con.execute(queries.SQL[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(map(repr, found.fetchall()))
    assert sorted(repr(tuple(r[n] for n in names)) for r in df.collect()) == want
