"""Job runs with deadlines, tables with one commit point, repeat-safe appends
and retention from a kept state."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from crowdscope.plans import incremental as N
from crowdscope.plans import retention as R
from crowdscope.session import path_exists, scratch_path
from crowdscope.sinks import keyed
from crowdscope.sinks.keyed import KeyedTable, WriterBusy, append_once, read_appended
from crowdscope.streaming.deadlines import job_runs, run_until

T0 = dt.datetime(2024, 3, 1)


def test_job_runs_expired_late_and_redelivered(spark):
    into, out, ckpt = (scratch_path(spark, n) for n in ("r-in", "r-out", "r-ckpt"))
    schema = "job_id long, kind string, at timestamp"

    def deliver(n, *rows):
        made = [(job, kind, None if hours is None else T0 + dt.timedelta(hours=hours)) for job, kind, hours in rows]
        spark.createDataFrame(made, schema).coalesce(1).write.parquet(f"{into}/d={n}")
        query = (job_runs(spark.readStream.schema(schema).parquet(f"{into}/d=*")).writeStream.format("parquet")
                 .option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        query.awaitTermination()
        return query.lastProgress["stateOperators"][0]["numRowsTotal"] if query.lastProgress else None

    def found():
        return {(r.job_id, r.status, (r.started_at - T0).total_seconds() / 3600, r.finished_at and (r.finished_at - T0).total_seconds() / 3600, r.redelivered)
                for r in spark.read.parquet(out).collect()}

    # 1 ends in time and is sent twice, 2 never ends, 3 ends too late; nulls and a `done` alone are nothing
    held = deliver(1, (1, "request", 0), (1, "request", 1), (1, "done", 2), (2, "request", 3), (3, "request", 4), (9, "done", 4),
                   (None, "request", 4), (8, "request", None), (8, "other", 4))
    assert held == 3
    assert found() == {(1, "EXECUTING", 0, None, 0), (2, "EXECUTING", 3, None, 0), (3, "EXECUTING", 4, None, 0)}
    held = deliver(2, (1, "request", 10), (3, "done", 25), (4, "request", 50))
    ended = {(1, "SUCCESS", 0, 2, 2), (2, "EXPIRED", 3, 23, 0), (3, "EXPIRED", 4, 24, 0)}
    assert ended <= found() and held == 1  # only the open run of job 4 is kept
    before = found()
    deliver(3, (1, "request", 0), (1, "done", 2), (2, "request", 3))  # delivered again when it is long over
    assert found() == before
    deliver(4, (1, "request", 60))  # a new run of an old job
    assert (1, "EXECUTING", 60, None, 0) in found()


def test_jobs_of_one_group_keep_their_own_deadlines(spark):
    """Hundreds of jobs share two state rows; each run ends by itself, with or without an event of its job."""
    into, out, ckpt = (scratch_path(spark, n) for n in ("g-in", "g-out", "g-ckpt"))
    schema, moment = "job_id long, kind string, at timestamp", lambda s: T0 + dt.timedelta(seconds=s)

    def deliver(n, rows):
        spark.createDataFrame([(job, kind, moment(s)) for job, kind, s in rows], schema).repartition(2).write.parquet(f"{into}/d={n}")
        query = (job_runs(spark.readStream.schema(schema).parquet(f"{into}/d=*"), 100, groups=2).writeStream.format("parquet")
                 .option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        query.awaitTermination()
        return query.lastProgress["stateOperators"][0]["numRowsTotal"]

    # job i asks at second i % 90; every third is done 10 s later, every fifth asks again 20 s later
    first = [(i, "request", i % 90) for i in range(300)] + [(i, "done", i % 90 + 10) for i in range(0, 300, 3)]
    assert deliver(1, first + [(i, "request", i % 90 + 20) for i in range(0, 300, 5)]) == 2
    found = lambda: {(r.job_id, r.status): ((r.started_at - T0).total_seconds(), r.finished_at and (r.finished_at - T0).total_seconds(), r.redelivered)
                     for r in spark.read.parquet(out).collect()}
    ends = {i: (i, "SUCCESS" if i % 3 == 0 else "EXPIRED") for i in range(300)}
    opened = {(i, "EXECUTING"): (i % 90, None, 0) for i in range(300)}
    over = {ends[i]: (i % 90, i % 90 + (10 if i % 3 == 0 else 100), int(i % 5 == 0)) for i in range(300)}
    newest = 105
    assert found() == opened | {e: r for e, r in over.items() if r[0] + 100 < newest}
    assert deliver(2, [(1000, "request", 150)]) == 2  # met by no other event, runs of both groups end
    assert found() == opened | {(1000, "EXECUTING"): (150, None, 0)} | {e: r for e, r in over.items() if r[0] + 100 < 150}
    assert deliver(3, [(1001, "request", 400)]) == 1
    assert found().keys() == opened.keys() | over.keys() | {(1000, "EXECUTING"), (1000, "EXPIRED"), (1001, "EXECUTING")}


def test_polling_stops_at_its_deadline(spark):
    query = spark.readStream.format("rate").load().writeStream.format("noop").start()
    assert run_until(query, 1) is False and not query.isActive


KV = "key string, value int, written_at int"


def test_keyed_table_changes_at_one_moment(spark, monkeypatch):
    path = scratch_path(spark, "keyed-table")
    table = KeyedTable(spark, path, ["key"], buckets=8)
    with pytest.raises(ValueError):
        table.read()
    rows = lambda df: {r.key: r.value for r in df.collect()}
    assert table.upsert(spark.createDataFrame([(f"k{i}", i, 1) for i in range(100)], KV)) == 1
    old, seen = table.read(), []
    commit = keyed.write_new

    def looked_at(s, name, text):  # just before the version file appears
        if "_versions" in name:
            seen.append(rows(KeyedTable(spark, path, ["key"]).read()))
            with pytest.raises(WriterBusy):
                KeyedTable(spark, path, ["key"]).upsert(spark.createDataFrame([("k1", 0, 9)], KV))
        return commit(s, name, text)

    monkeypatch.setattr(keyed, "write_new", looked_at)
    new = spark.createDataFrame([("k1", -1, 2), ("k1", -2, 3), ("k2", -3, 0), ("new", 7, 1), (None, 8, 1)], KV)
    assert table.upsert(new) == 2
    assert seen == [{f"k{i}": i for i in range(100)}]
    want = {f"k{i}": i for i in range(100)} | {"k1": -2, "new": 7, None: 8}
    assert rows(table.read()) == want and rows(old) == seen[0] and rows(table.read(1)) == seen[0]
    _, before = table._current(1)
    _, after = table._current(2)
    assert 1 <= sum(after[b] != before.get(b) for b in after) <= 4  # only touched buckets have new files

    def lost(s, name, text):
        if "_versions" in name:
            raise RuntimeError("store is gone")
        return commit(s, name, text)

    monkeypatch.setattr(keyed, "write_new", lost)
    with pytest.raises(RuntimeError):
        table.upsert(spark.createDataFrame([("k3", 0, 9)], KV))
    monkeypatch.setattr(keyed, "write_new", commit)
    assert rows(table.read()) == want and not path_exists(spark, f"{path}/_writer")
    assert table.upsert(spark.createDataFrame([], KV)) == 2
    assert table.upsert(spark.createDataFrame([("k3", 33, 9)], KV)) == 3
    assert table.vacuum(1) >= 1 and rows(table.read()) == want | {"k3": 33}
    with pytest.raises(ValueError):
        KeyedTable(spark, path, ["value"]).read()


def test_append_of_a_repeated_run(spark, monkeypatch):
    path = scratch_path(spark, "runs")
    one = spark.createDataFrame([(1, "a"), (2, "b")], "id int, day string")
    with pytest.raises(ValueError):
        read_appended(spark, path)
    assert append_once(one, path, "2024-01-01", ["day"]) and not append_once(one.union(one), path, "2024-01-01", ["day"])
    with pytest.raises(ValueError):
        append_once(one, path, "../x")
    commit = keyed.write_new

    def lost(*args):
        raise RuntimeError("store is gone")

    monkeypatch.setattr(keyed, "write_new", lost)
    with pytest.raises(RuntimeError):
        append_once(one, path, "2024-01-02", ["day"])
    assert read_appended(spark, path).count() == 2  # the failed run's files are not read
    monkeypatch.setattr(keyed, "write_new", commit)
    assert append_once(one.withColumn("extra", F.lit(1)), path, "2024-01-02", ["day"])
    back = read_appended(spark, path)
    assert back.count() == 4 and back.filter("extra = 1").count() == 2
    assert not append_once(spark.createDataFrame([], one.schema), path, "2024-01-02")


def test_incremental_retention_equals_the_scan_day_by_day(spark):
    import random
    rng = random.Random(2)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for uid in [0] * 300 + list(range(1, 60)) * 6 + [None]:  # a hot user
        at = start + dt.timedelta(days=rng.randint(0, 40), seconds=rng.choice([0, 0, 1, 40_000, 86_399]), microseconds=rng.choice([0, 400, 1000]))
        rows.append((uid, at, rng.choice(["install", "read", "read"])))
    events = spark.createDataFrame(rows, "uid long, ts timestamp_ntz, mevent string").cache()
    members = spark.createDataFrame([("all", i) for i in range(60)] + [("few", 0), ("few", 0), ("none", 99)], "segment_id string, uid long").cache()
    windows, back = (("d2", 2), ("w1", 7)), 20
    first = dt.date(2024, 1, 25)
    state = N.scanned_days(events, first - dt.timedelta(days=back + 5), first)
    for i in range(8):
        day = first + dt.timedelta(days=i)
        if i:
            state = N.merge_state(state, N.scanned_days(events, day - dt.timedelta(days=1), day), day, back)
        else:
            state = N.merge_state(state, state.limit(0), day, back)
        path = scratch_path(spark, "state")
        state.write.parquet(path)
        state = spark.read.parquet(path)
        got = N.retention_of_state(state, members, day, back, windows, with_timestamp=False)
        want = R.daily_retention(events, members, day, back, windows).drop("lastupdatedtime")
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str), day
    assert state.filter("idate IS NULL").groupBy("uid").count().filter("count > 1").isEmpty()
