import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crowdscope.session import local_path, scratch_path
from crowdscope.sinks.writers import job_status_rows, key_bucket, upsert, write_table
from crowdscope.sources.payloads import job_requests, segment_members, segment_payload_rejects, submitted_jobs
from crowdscope.sources.tables import time_range
from crowdscope.sources.text import read_delimited

SCHEMA = T.StructType([T.StructField("empId", T.IntegerType()), T.StructField("group", T.StringType()),
                       T.StructField("salary", T.IntegerType())])


def _write_lines(spark, lines):
    path = scratch_path(spark, "lines")
    os.makedirs(local_path(path), exist_ok=True)
    with open(os.path.join(local_path(path), "part-0.txt"), "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_delimited_text_drops_wrong_arity(spark):
    path = _write_lines(spark, ["1\ta\t5", "bad", "2\tb\t7", "3\tc\t9\textra", "4\td\t"])
    df = read_delimited(spark, path, SCHEMA)
    assert sorted(tuple(r) for r in df.collect()) == [(1, "a", 5), (2, "b", 7)]
    assert df.count() == 2


def test_delimited_text_bad_number(spark):
    path = _write_lines(spark, ["q\tz\t1", "2\tb\t7"])
    with pytest.raises(Exception):
        read_delimited(spark, path, SCHEMA).collect()
    assert [tuple(r) for r in read_delimited(spark, path, SCHEMA, strict=False).orderBy("salary").collect()] == [
        (None, "z", 1), (2, "b", 7)]


def test_segment_payloads(spark):
    df = spark.createDataFrame([("s1", '{"users":["a","b","a"]}'), ("s2", '{"users":[1, 2]}'),
                                ("s3", "not json"), ("s4", '{"users":[]}')], "segment_id string, payload string")
    rows = sorted(tuple(r) for r in segment_members(df).collect())
    assert rows == [("s1", "a"), ("s1", "a"), ("s1", "b"), ("s2", "1"), ("s2", "2")]
    rej = {r.segment_id: r.rejected_payloads for r in segment_payload_rejects(df).collect()}
    assert rej == {"s1": 0, "s2": 0, "s3": 1, "s4": 0}


def test_job_requests(spark):
    payload = ('{"response":[{"jobId":12.0,"jobStatus":"SUBMITTED","inputData":{"segmentid":"a","app":"news_app",'
               '"segmentid_compare":"b"}},{"jobId":13,"jobStatus":"EXECUTING","inputData":{"segmentid":"c",'
               '"app":"news_app","segmentid_compare":"d"}},{"jobId":14,"jobStatus":"SUBMITTED","inputData":'
               '{"segmentid":"e","app":"other","segmentid_compare":"f"}}]}')
    df = spark.createDataFrame([(payload,)], "payload string")
    jobs = job_requests(df)
    assert jobs.count() == 3
    sub = submitted_jobs(jobs, "news_app").collect()
    assert [(r.job_id, r.segment_id, r.segment_compare) for r in sub] == [(12, "a", "b")]


def test_time_range_is_half_open_at_ms_and_pushed(spark):
    base = dt.datetime(2024, 1, 10)
    ms = dt.timedelta(milliseconds=1)
    rows = [(1, base), (2, base + ms), (3, dt.datetime(2024, 1, 20)), (4, dt.datetime(2024, 1, 20) + ms)]
    path = scratch_path(spark, "ts")
    spark.createDataFrame(rows, "id int, ts timestamp_ntz").write.parquet(path)
    df = time_range(spark.read.parquet(path), "ts", "2024-01-10 00:00:00", "2024-01-20 00:00:00")
    assert sorted(r.id for r in df.collect()) == [2, 3]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


def test_write_modes_and_upsert(spark):
    path = scratch_path(spark, "kv")
    kv = spark.createDataFrame([("key11", 11), ("key12", 12)], "key string, value int")
    write_table(kv, path, "errorifexists")
    with pytest.raises(Exception):
        write_table(kv, path, "errorifexists")
    write_table(kv.withColumn("value", F.col("value") + 1), path, "append")
    assert spark.read.parquet(path).count() == 4
    old = kv.withColumn("written_at", F.lit(1))
    new = spark.createDataFrame([("key11", 99, 2)], "key string, value int, written_at int")
    got = {r.key: r.value for r in upsert(old, new, ["key"]).collect()}
    assert got == {"key11": 99, "key12": 12}


def test_bucketed_partition_write(spark):
    path = scratch_path(spark, "bucketed")
    df = spark.range(1000).withColumnRenamed("id", "uid")
    write_table(df, path, "errorifexists", bucket_keys=["uid"], buckets=8)
    back = spark.read.parquet(path)
    assert back.count() == 1000
    assert back.select("key_bucket").distinct().count() == 8
    assert back.filter(key_bucket(["uid"], 8) != F.col("key_bucket")).count() == 0


def test_status_rows(spark):
    jobs = spark.createDataFrame([(5,)], "job_id int")
    reports = spark.createDataFrame([(5, "[]", "[]")], "job_id int, result string, result_compare string")
    failed = spark.createDataFrame([(6, "boom")], "job_id int, error string")
    rows = job_status_rows(jobs, reports, failed).orderBy("completion_pct").collect()
    assert [(r.status, r.completion_pct) for r in rows] == [
        ("FAILED", None), ("EXECUTING", 0), ("EXECUTING", 20), ("EXECUTING", 40), ("EXECUTING", 60),
        ("EXECUTING", 80), ("SUCCESS", 100)]
    import json
    done = json.loads(rows[-1].payload)
    assert done["response"]["result"] == "[]" and done["completionPercentage"] == 100


def test_distinct_count_exact_and_approximate(spark):
    from crowdscope.operators.aggregates import distinct_count
    e = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    exact = distinct_count(e, "user_id").first()[0]
    approx = distinct_count(e, "user_id", approx=True, rsd=0.02).first()[0]
    assert exact == 150 and abs(approx - exact) <= 0.1 * exact


def test_upsert_table_rewrites_only_touched_buckets(spark):
    from crowdscope.sinks.writers import upsert_table
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        "user_id", "event_id", "value", F.col("ts").alias("written_at"))
    path = scratch_path(spark, "keyed")
    upsert_table(e, path, ["user_id"], tiebreak=[F.desc("event_id")], buckets=8)
    root = local_path(path)

    def files():
        return {d: sorted(os.listdir(os.path.join(root, d))) for d in os.listdir(root) if d.startswith("key_bucket=")}

    before = files()
    assert len(before) == 8
    newer = spark.createDataFrame([(3, 10**9, 42.0, dt.datetime(2030, 1, 1))],
                                  "user_id bigint, event_id bigint, value double, written_at timestamp_ntz")
    upsert_table(newer, path, ["user_id"], tiebreak=[F.desc("event_id")], buckets=8)
    after = files()
    changed = [d for d in before if before[d] != after[d]]
    assert len(changed) == 1                        # only user 3's bucket was rewritten
    table = spark.read.parquet(path)
    assert table.count() == e.select("user_id").distinct().count()
    assert table.filter("user_id = 3").first().value == 42.0


def test_large_directory_is_written_by_several_tasks(spark):
    path = scratch_path(spark, "hot-day")
    df = spark.range(400_000, numPartitions=8).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h"),
                                                     F.lit("2024-01-01").alias("day"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "1m")
    try:
        write_table(df, path, "errorifexists", ["day"])
    finally:
        spark.conf.unset(key)
    names = [f for f in os.listdir(os.path.join(local_path(path), "day=2024-01-01")) if f.startswith("part-")]
    assert len(names) > 1 and spark.read.parquet(path).count() == 400_000
