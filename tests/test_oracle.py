"""Every registered query against its oracle SQL on DuckDB (sf0.001):
same row count, same column names, same values (order-insensitive)."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from check_oracle import TABLES, _rows

ORACLE = entry.oracle_sql()
ROWS_ONLY = sorted(set(entry.queries()) - set(ORACLE))


@pytest.fixture(scope="module")
def duck(small_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small_dir}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, small_dir, name):
    df = entry.queries()[name](spark, small_dir)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[name])
    ocols, orows = [d[0] for d in cur.description], cur.fetchall()
    assert len(rows) == len(orows)
    assert sorted(cols) == sorted(ocols)
    assert _rows(cols, rows) == _rows(ocols, orows)


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_queries_run(spark, small_dir, name):
    df = entry.queries()[name](spark, small_dir)
    assert df.count() > 0
