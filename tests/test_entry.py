"""The driver's contract, streams, and every core query against its SQL."""

import os
import subprocess
import sys
from datetime import datetime

import duckdb
import pytest

import __spark_entry__ as entry
from newsquarry import queries
from newsquarry.streaming import ingest

CORE = sorted(queries.QUERIES)


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


def table_of(rows, columns):
    order = sorted(columns)
    return sorted(tuple(str(plain(r[columns.index(c)])) for c in order) for r in rows)


@pytest.mark.parametrize("name", CORE)
def test_core_query(spark, small, name):
    df = queries.QUERIES[name](spark, small)  # in a session that is not in UTC
    rows = [tuple(r) for r in df.collect()]
    if name in queries.SQL:
        c = duckdb.connect()
        c.execute("SET timezone = 'UTC'")
        for f in os.listdir(small):
            c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{small}/{f}'")
        r = c.execute(queries.SQL[name])
        columns = [d[0] for d in r.description]
        assert sorted(columns) == sorted(df.columns)
        assert table_of(rows, df.columns) == table_of(r.fetchall(), columns)


def test_entry(spark, small):
    assert set(CORE) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    if os.path.exists("/root/testdata/sf0.001"):
        assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("module", ["newsquarry.plans.registered", "newsquarry.plans.workflow", "newsquarry.queries", "__spark_entry__"])
def test_modules_are_imported_in_any_order(module):
    # a worker that is new imports the module of an injected function first, as for udf_negative
    home = os.path.dirname(os.path.abspath(entry.__file__))
    r = subprocess.run([sys.executable, "-c", f"import {module}, newsquarry.queries as q; print(len(q.QUERIES))"], cwd=home, capture_output=True, text=True, timeout=120)
    assert r.returncode == 0 and int(r.stdout) == len(CORE), r.stderr


def test_merge_stream_repeats_nothing(spark, tmp_path):
    from newsquarry.operators.ingest import merge_by_key

    src, store = str(tmp_path / "in"), str(tmp_path / "store")
    merge = lambda df: merge_by_key(df, ["id"], ["at"], ["v"])
    spark.createDataFrame([("a", 1, None), ("b", 1, "x")], "id string, at int, v string").write.parquet(src)
    ingest.merge_stream(ingest.stream_of(spark, src), store, ["id"], merge, buckets=2)
    spark.createDataFrame([("a", 2, "y"), ("c", 2, "z")], "id string, at int, v string").write.mode("append").parquet(src)
    ingest.merge_stream(ingest.stream_of(spark, src), store, ["id"], merge, buckets=2)
    ingest.merge_stream(ingest.stream_of(spark, src), store, ["id"], merge, buckets=2)
    assert sorted((r.id, r.v) for r in ingest.merged_table(spark, store).collect()) == [("a", "y"), ("b", "x"), ("c", "z")]


def test_first_arrivals_keep_late_keys(spark, tmp_path):
    src, store = str(tmp_path / "in"), str(tmp_path / "store")
    schema = "id string, at timestamp, x int"
    days = [20, 1, 10, 1, 30]  # files that are not in order of time
    for n, day in enumerate(days):
        rows = [(f"k{n}", datetime(2024, 1, day), n), ("same", datetime(2024, 1, day), n), (None, datetime(2024, 1, day), n)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
    got = ingest.first_arrivals(ingest.stream_of(spark, src, 1), ["id"], "at", store, buckets=4)
    assert sorted(str(r.id) for r in got.collect()) == ["None", *[f"k{n}" for n in range(5)], "same"]
    again = ingest.first_arrivals(ingest.stream_of(spark, src, 1), ["id"], "at", store, buckets=4)
    assert again.count() == 7
    spark.createDataFrame([("k0", datetime(2023, 1, 1), 9), ("k9", datetime(2023, 1, 1), 9)], schema).coalesce(1).write.mode("append").parquet(src)
    assert ingest.first_arrivals(ingest.stream_of(spark, src, 1), ["id"], "at", store, buckets=4).count() == 8
