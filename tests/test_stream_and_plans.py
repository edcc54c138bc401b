import json
import re

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from crowdscope.operators.aggregates import daily_user_activity
from crowdscope.plans import inputs as I
from crowdscope.plans import profile as P
from crowdscope.session import scratch_path
from crowdscope.streaming.jobs import read_reports, read_status, start_job_stream
from tests.conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_stream_runs_twice_on_one_checkpoint(spark):
    t = I.Tables(spark, SF001)
    jobs_dir, out_dir, ckpt = (scratch_path(spark, n) for n in ("t-jobs", "t-out", "t-ckpt"))
    def base():
        f = I.Tables(spark, SF001, fresh=True)
        return P.profile_base(I.profiles(f), I.preferences(f), I.device_prices(f))

    members = lambda: I.members(I.Tables(spark, SF001, fresh=True))
    I.job_payloads(t).coalesce(1).write.text(f"{jobs_dir}/d=1")

    def run():
        q = start_job_stream(spark, jobs_dir, out_dir, ckpt, members, base, I.APP, available_now=True,
                             files_per_batch=1)
        q.awaitTermination()

    run()
    first = read_reports(spark, out_dir)
    n_first = first.count()
    assert n_first == 3                                     # submitted jobs for the app only
    batches_before = spark.read.parquet(f"{out_dir}/reports").select("batch_id").distinct().count()
    run()                                                   # nothing new: no new batch output
    assert spark.read.parquet(f"{out_dir}/reports").select("batch_id").distinct().count() == batches_before
    I.job_payloads(t).coalesce(1).write.text(f"{jobs_dir}/d=2")   # the same jobs delivered again
    run()
    assert spark.read.parquet(f"{out_dir}/reports").count() == n_first
    report = json.loads(first.first().result)
    assert len(report) == 10
    status = read_status(spark, out_dir)
    assert status.filter("status = 'SUCCESS'").count() == 3


def _payload(job, segment, requested_at):
    return json.dumps({"response": [{"jobId": float(job), "jobStatus": "SUBMITTED", "requested_at": requested_at,
                                     "inputData": {"segmentid": segment, "app": I.APP, "segmentid_compare": "all"}}]})


def test_stream_loses_no_job(spark):
    """Late and undated requests, a request without a segment, and a batch
    that failed for a broken table and is repeated."""
    jobs_dir, out_dir, ckpt = (scratch_path(spark, n) for n in ("l-jobs", "l-out", "l-ckpt"))
    members = lambda: I.members(I.Tables(spark, SF001, fresh=True))
    broken = {"on": False}

    def base():
        if broken["on"]:
            return spark.read.parquet(f"{SF001}/no_such_table.parquet")
        f = I.Tables(spark, SF001, fresh=True)
        return P.profile_base(I.profiles(f), I.preferences(f), I.device_prices(f))

    def run(n, *payloads):
        spark.createDataFrame([(x,) for x in payloads], "value string").coalesce(1).write.text(f"{jobs_dir}/d={n}")
        start_job_stream(spark, jobs_dir, out_dir, ckpt, members, base, I.APP, available_now=True).awaitTermination()

    def final():
        return {(r.job_id, r.status) for r in read_status(spark, out_dir).filter("status <> 'EXECUTING'").collect()}

    run(1, _payload(1, "building", "2024-05-10T00:00:00.000Z"))
    broken["on"] = True
    with pytest.raises(StreamingQueryException):
        run(2, _payload(2, "furniture", "2024-05-01T00:00:00.000Z"), _payload(3, "all", None))
    assert final() == {(1, "SUCCESS")}
    broken["on"] = False
    run(3, _payload(4, None, "2024-05-10T00:00:00.000Z"), _payload(5, "building", "2024-05-10T00:00:00.000Z"))
    assert final() == {(1, "SUCCESS"), (2, "SUCCESS"), (3, "SUCCESS"), (4, "FAILED"), (5, "SUCCESS")}
    run(4, _payload(4, "building", "2024-05-10T00:00:00.000Z"))
    assert (4, "SUCCESS") in final()


def test_time_filter_reaches_parquet_scan(spark):
    e = spark.read.parquet(f"{SF001}/events.parquet")
    df = e.filter(F.col("ts").cast("date") >= F.lit("2024-01-05").cast("date")).select("event_id")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_daily_activity_has_no_expand(spark):
    df = daily_user_activity(I.app_events(I.Tables(spark, SF001)))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan


def test_feature_shares_scans_each_input_once(spark):
    t = I.Tables(spark, SF001)
    base = P.profile_base(I.profiles(t), I.preferences(t), I.device_prices(t))
    members_only = t.customer.selectExpr("'x' AS segment_id", "c_custkey AS uid")
    df = P.feature_shares(members_only, base)
    logical = df._jdf.queryExecution().optimizedPlan().toString()
    assert logical.count("Generate inline") == 1          # one generator, not a ten-way union
    assert "Union" not in logical


def test_top_features_uses_group_limit(spark):
    t = I.Tables(spark, SF001)
    base = P.profile_base(I.profiles(t), I.preferences(t), I.device_prices(t))
    df = P.top_features(*P.counted(I.members(t), base))
    plan = _plan(df)
    assert re.search(r"WindowGroupLimit .*Final.*Exchange hashpartitioning\(segment_id#\d+, feature#\d+,"
                     r".*WindowGroupLimit .*Partial", plan, re.S), plan
    windows = df._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"windowspecdefinition\(segment_id#\d+, specified", windows)


def test_price_lookup_broadcast_is_a_runtime_size_decision(spark):
    """No broadcast hint is written; AQE measures the lookup and broadcasts
    it because it is small, and keeps a sort-merge join when it is not."""
    t = I.Tables(spark, SF001)
    base = P.profile_base(I.profiles(t), I.preferences(t), I.device_prices(t))
    base.collect()
    final = _plan(base).split("Initial Plan")[0]
    assert re.search(r"BroadcastHashJoin \[dtype2#\d+\]", final)
    try:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        again = P.profile_base(I.profiles(t), I.preferences(t), I.device_prices(t))
        again.collect()
        assert re.search(r"SortMergeJoin \[dtype2#\d+\]", _plan(again).split("Initial Plan")[0])
    finally:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_uid_bucketed_events_need_no_shuffle(spark):
    from crowdscope.plans import retention as R
    from crowdscope.sinks.writers import save_bucketed
    ev = I.app_events(I.Tables(spark, SF001))
    save_bucketed(ev, "events_by_uid", ["uid"], 8, mode="overwrite")
    table = spark.table("events_by_uid")
    activity = daily_user_activity(table)
    summary = R.user_summary(table.select("uid", F.to_date("timestamp").alias("d"), "mevent"))
    for df in (activity, summary):
        df.collect()
        final = _plan(df).split("Initial Plan")[0]
        assert "Exchange" not in final, final
    expected = daily_user_activity(ev)
    assert activity.exceptAll(expected).count() == 0 and expected.exceptAll(activity).count() == 0
