"""Every query of the subpackage runs over whole tables; those with SQL agree with it."""

import os

import duckdb
import pytest

from newsquarry.llm import queries


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, small, name):
    df = queries.QUERIES[name](spark, small)
    rows = [tuple(r) for r in df.collect()]
    if name.endswith("_found"):
        assert len(rows) == len(set(rows))
    if name in queries.SQL:
        c = duckdb.connect()
        for f in os.listdir(small):
            c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{small}/{f}'")
        r = c.execute(queries.SQL[name])
        columns = [d[0] for d in r.description]
        order = sorted(columns)
        assert sorted(df.columns) == order
        assert sorted(tuple(x[df.columns.index(k)] for k in order) for x in rows) == sorted(tuple(x[columns.index(k)] for k in order) for x in r.fetchall())
