"""Every registered query against its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from helpers import SF_SMALL
from tools.check_oracle import TABLES, digest

SQL = E.oracle_sql()
SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "boolean": "BOOLEAN",
                 "int": "INTEGER", "double": "DOUBLE"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_runs_and_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["ord", "chunk_no", "url", "data"] and df.count() > 0
    assert set(SQL) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    s_cols, s_n, s_h, _ = digest(df.columns, [tuple(r) for r in df.collect()])
    if name not in SQL:
        assert s_n > 0
        return
    res = con.sql(SQL[name])
    s_types = sorted((f.name, SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()))
                     for f in df.schema.fields)
    assert s_types == sorted(zip(res.columns, [str(t) for t in res.types]))
    d_cols, d_n, d_h, _ = digest(list(res.columns), res.fetchall())
    assert (s_cols, s_n) == (d_cols, d_n)
    assert s_h == d_h
