"""Changed records only: against a plain comparison, and through failures."""

import os
import random
from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsquarry.functions.dates import instant
from newsquarry.operators import incremental
from newsquarry.operators.incremental import ChangeStore, due_records, last_success, levels_for, run_consumers, save_trees
from newsquarry.sources.versions import PublishedElsewhere, Versions

SPELL = ["%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S.000Z"]


def spell(t, r):
    k = r.randrange(4)
    return t.strftime(SPELL[k]) if k < 3 else (t + timedelta(hours=7)).strftime("%Y-%m-%dT%H:%M:%S+07:00")


def rows(spark, data, schema):
    return spark.createDataFrame(data, schema)


REC = "article_id string, fetched_at string, matched_at string, k string, at string"
LOG = "state_key string, value string, updated_at string, mark string"


def test_instants(spark):
    cases = {"2024-01-02T03:04:05Z": 1704164645, "2024-01-02 03:04:05": 1704164645, " 2024-01-02T10:04:05+07:00 ": 1704164645, "2024-01-02T03:04:05.500Z": 1704164645, "2024-01-02": 1704153600, "failed 2024-01-02T03:04:05Z": None, "": None, "null": None, "2024-13-02T03:04:05Z": None, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = {r.s: r.n for r in df.select("s", instant("s").cast("long").alias("n")).collect()}
    assert got == cases


def test_last_success_takes_the_latest_run(spark):
    log = rows(spark, [("a", "2024-01-05T00:00:00Z", "2024-01-06T00:00:00Z", None), ("a", "2024-01-09T00:00:00Z (aborted)", "2024-01-10T00:00:00Z", None), ("a", "2024-01-07 00:00:00", "2024-01-08T00:00:00Z", None), ("b", "failed", "2024-01-08T00:00:00Z", None), ("b", None, "2024-01-09T00:00:00Z", None), (None, "2024-01-07 00:00:00", "2024-01-08T00:00:00Z", None), ("c", "2024-01-07 00:00:00", None, None)], LOG)
    got = {r.state_key: r.mark for r in last_success(log).select("state_key", (instant("value") if False else "mark")).collect()}
    assert set(got) == {"a", "b", "c"} and got["b"] is None and got["a"] is not None and got["c"] is not None


@pytest.mark.parametrize("seed", range(3))
def test_due_equals_comparison(spark, seed):
    r = random.Random(seed)
    base = datetime(2024, 1, 1, tzinfo=timezone.utc)
    times = [base + timedelta(hours=h) for h in range(40)]
    recs, truth = [], {}
    for i in range(300):
        f, m = r.choice(times), r.choice(times) if r.random() < 0.7 else None
        recs.append((f"id{i % 250}", spell(f, r), spell(m, r) if m else r.choice([None, "", "soon"]), "x", "y"))
        truth.setdefault(f"id{i % 250}", []).append(max(f, m) if m else f)
    recs += recs[:20]
    marks = {f"c{j}": r.choice(times) for j in range(5)}
    log = [(c, spell(t, r), "2024-02-01T00:00:00Z", None) for c, t in marks.items()] + [("never", "failed", "2024-02-01T00:00:00Z", None), ("c0", "2023-01-01T00:00:00Z", "2023-01-01T01:00:00Z", None), ("c0", "failed 2025-01-01T00:00:00Z", "2025-01-01T00:00:00Z", None)]
    got = sorted(tuple(x) for x in due_records(rows(spark, recs, REC), rows(spark, log, LOG), "article_id", ["fetched_at", "matched_at"]).collect())
    want = sorted([(c, k) for c, t in marks.items() for k, ts in truth.items() if max(ts) >= t] + [("never", k) for k in truth])
    assert got == want


def test_empty_tables_and_nulls(spark):
    none = rows(spark, [], REC)
    log = rows(spark, [("a", "2024-01-05T00:00:00Z", "2024-01-06T00:00:00Z", None), ("n", None, None, None)], LOG)
    assert due_records(none, log, "article_id", ["fetched_at", "matched_at"]).count() == 0
    some = rows(spark, [("x", None, None, None, None), (None, "2024-01-06T00:00:00Z", None, None, None), ("z", "2024-01-05T00:00:00Z", None, None, None)], REC)
    assert due_records(some, rows(spark, [], LOG), "article_id", ["fetched_at", "matched_at"]).count() == 0
    got = sorted(tuple(r) for r in due_records(some, log, "article_id", ["fetched_at", "matched_at"]).collect())
    assert got == [("a", "z"), ("n", "x"), ("n", "z")]


def test_store_publishes_output_and_tree_together(spark, tmp_path):
    cols = "id string, v string"
    store = ChangeStore(spark, str(tmp_path / "s"), "id", ["v"])
    write = lambda df, path: df.write.parquet(path)
    ids = lambda: sorted(r.id for r in spark.read.parquet(store.output()).collect())
    first = spark.createDataFrame([(f"r{i}", "a") for i in range(50)], cols)
    assert store.run(first, write) == 1 and len(ids()) == 50
    assert store.run(first.unionAll(first), write) == 1  # nothing new, repeated rows don't matter
    second = spark.createDataFrame([(f"r{i}", "b" if i in (3, 4) else "a") for i in range(50)] + [("new", "a"), (None, "q")], cols)

    def fails(df, path):
        df.write.parquet(path)
        raise OSError("lost")

    with pytest.raises(OSError):
        store.run(second, fails)
    assert store.versions() == [1]
    assert store.run(second, write) == 2 and ids() == ["new", "r3", "r4"]
    third = spark.createDataFrame([(f"r{i}", "b" if i in (3, 4) else "a") for i in range(49)] + [("new", "z")], cols)
    assert store.run(third, write) == 3 and ids() == ["new"]  # r49 is gone, which gives no row
    assert store.run(third, write) == 3 and spark.read.parquet(store.output(1)).count() == 50


def test_two_runs_from_one_version(spark, tmp_path):
    folder, cols = str(tmp_path / "s"), "id string, v string"
    one, two = ChangeStore(spark, folder, "id", ["v"]), ChangeStore(spark, folder, "id", ["v"])
    rows = spark.createDataFrame([("a", "1")], cols)

    def overtaken(df, path):
        two.run(rows, lambda d, p: d.write.parquet(p))  # another run publishes while this one writes
        df.write.parquet(path)

    with pytest.raises(PublishedElsewhere):
        one.run(rows, overtaken)
    assert one.versions() == [1] and spark.read.parquet(one.output()).count() == 1
    versions = Versions(spark, folder)
    versions._fs.create(versions._path(f"{folder}/_markers/v2"), False).close()  # a run that is about to publish
    with pytest.raises(PublishedElsewhere):
        one.run(rows.withColumn("v", F.lit("2")), lambda d, p: d.write.parquet(p))
    os.utime(f"{folder}/_markers/v2", (1, 1))  # and one that died there
    assert one.run(rows.withColumn("v", F.lit("2")), lambda d, p: d.write.parquet(p)) == 3 and one.versions() == [1, 3]


def test_row_that_arrives_during_a_run_is_left_to_the_next(spark, tmp_path):
    src, cols = str(tmp_path / "in"), "id string, v string"
    spark.createDataFrame([("a", "1")], cols).write.parquet(src)
    store = ChangeStore(spark, str(tmp_path / "s"), "id", ["v"])

    def write(df, path):
        spark.createDataFrame([("b", "1")], cols).write.mode("append").parquet(src)
        df.write.parquet(path)

    store.run(spark.read.parquet(src), write)
    assert [r.id for r in spark.read.parquet(store.output()).collect()] == ["a"]
    store.run(spark.read.parquet(src), lambda d, p: d.write.parquet(p))
    assert [r.id for r in spark.read.parquet(store.output()).collect()] == ["b"]


def test_entries_are_written_together_and_trees_grow(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "MAX_SPREAD", 2)
    monkeypatch.setattr(incremental, "LEAF_KEYS", 1)
    monkeypatch.setattr(incremental, "MIN_LEVELS", 1)
    store = ChangeStore(spark, str(tmp_path / "s"), "id", ["v"])
    data = {f"r{i}": 0 for i in range(12)}
    r = random.Random(5)
    for n in range(1, 7):
        changed = set(r.sample(sorted(data), 2)) | ({f"n{n}{i}" for i in range(300)} if n == 5 else {f"n{n}"})
        data |= dict.fromkeys(changed, n)
        store.run(spark.createDataFrame(sorted(data.items()), "id string, v int"), lambda d, p: d.write.parquet(p))
        got = {x.id for x in spark.read.parquet(store.output()).collect()}
        assert got == (changed if n > 1 else set(data))
        assert spark.read.parquet(f"{store.folder}/{store.store.last()[1]['data']}/tree").select("source").distinct().count() <= 3
    assert store.store.last()[1]["levels"] > 1
    assert [levels_for(n) for n in (0, 10**5, 10**9, 10**12)] == [1, 5, 7, 7]


def test_the_run_knows_hashes_only(spark):
    """A record that changed without a newer instant is due as well, and one that is equal is not, whatever the log says."""
    state = spark.createDataFrame([("a", 1), ("b", 2), ("c", 9)], "k string, at long").withColumn("at", F.timestamp_seconds("at"))
    steps = [datetime.fromtimestamp(5), datetime.fromtimestamp(20)]
    import tempfile

    saved = save_trees(state, steps, tempfile.mkdtemp() + "/t", 2)
    now = state.select("k", F.when(F.col("k") == "b", F.lit(7).cast("long")).otherwise(F.xxhash64("k", "at")).alias("h"))
    runs = spark.createDataFrame([("x", 0), ("y", 1), ("z", -1)], "consumer string, step int")
    got = sorted(tuple(r) for r in run_consumers(now, runs, saved, 2).collect())
    assert got == [("x", "b"), ("x", "c"), ("y", "b"), ("z", "a"), ("z", "b"), ("z", "c")]


@settings(max_examples=15, deadline=None)
@given(st.integers(0, 10**9))
def test_spellings_are_one_instant(n):
    t = datetime(2020, 1, 1, tzinfo=timezone.utc) + timedelta(seconds=n)
    r = random.Random(n)
    texts = {spell(t, r) for _ in range(6)}
    assert all(datetime.fromisoformat(x.replace("Z", "+00:00") if ("Z" in x or "+" in x) else x + "+00:00") == t for x in texts)
