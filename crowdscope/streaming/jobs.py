"""Profile requests as a Structured Streaming job.

Job requests arrive as JSON text files in a directory. Each micro-batch:
  * parses and keeps submitted jobs for the app (S8, S9);
  * leaves out jobs that already have a ``SUCCESS`` status, so a re-delivered
    request does no work twice, while a late, undated or formerly failed one
    is served whenever it comes (nothing is dropped by event time);
  * writes the ``EXECUTING`` rows of its jobs before their work begins;
  * works on **all** jobs of the batch at once, in four steps, each landed
    before its status row says so: the members of the segments that the jobs
    name (20 %), the feature counts (40), the comparison (60), the reports
    (80); then the final status rows follow.

A request without a segment gets a ``FAILED`` row; its neighbours go on. Any
other error (an unreadable table, a lost store) fails the micro-batch, and the
checkpoint repeats it when the stream starts again: no request is lost to it.

Writes are idempotent per micro-batch: each batch writes its own
``batch=<id>`` folders with ``overwrite``, so a batch re-run after a failure
replaces its own output instead of duplicating it. Readers take the latest
row per ``job_id`` (:func:`crowdscope.sinks.writers.latest_by_key`).

Profiles and member lists are read lazily inside each batch, so every
batch sees the tables as they are at that moment.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from crowdscope.plans import profile as P
from crowdscope.session import path_exists, remove_path
from crowdscope.sinks.writers import PROGRESS_POINTS, job_status_rows, latest_by_key
from crowdscope.sources.payloads import job_requests, submitted_jobs


def job_request_stream(spark: SparkSession, jobs_dir: str, app: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    raw = reader.load(jobs_dir).withColumnRenamed("value", "payload")
    return submitted_jobs(job_requests(raw), app)


def profile_batch_writer(spark: SparkSession, members: Callable[[], DataFrame], base: Callable[[], DataFrame],
                         out_dir: str, k: int = P.TOP_K):
    """``foreachBatch`` function: profile every open job of the batch at once.

    The batch's open requests are first written as a small table under
    ``out_dir`` and read back through the main session. That cuts the
    streaming lineage, gets the profile plan AQE (micro-batch plans run with
    it off), and makes a retried batch rewrite the same folder.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        req_path = f"{out_dir}/requests/batch={batch_id}"
        asked = batch.select("job_id", "segment_id", "segment_compare", "requested_at").dropDuplicates(["job_id"])
        if path_exists(spark, f"{out_dir}/status"):
            earlier = batch.sparkSession.read.parquet(f"{out_dir}/status")
            done = earlier.filter((F.col("status") == "SUCCESS") & (F.col("batch_id") != batch_id)).select("job_id")
            asked = asked.join(done, "job_id", "left_anti")
        asked.write.mode("overwrite").parquet(req_path)
        jobs = spark.read.parquet(req_path)
        if jobs.isEmpty():        # all of them finished before
            return

        def status(rows: DataFrame, step: str) -> None:
            (rows.withColumn("batch_id", F.lit(batch_id).cast("long"))
             .write.mode("overwrite").parquet(f"{out_dir}/status/batch={batch_id}/step={step}"))

        status(job_status_rows(jobs, points=(0,)), "accepted")
        whole = F.col("segment_id").isNotNull() & F.col("segment_compare").isNotNull()
        good, bad = jobs.filter(whole), jobs.filter(~whole)
        work = f"{out_dir}/work/batch={batch_id}"

        def landed(rows: DataFrame, step: str) -> DataFrame:
            rows.write.mode("overwrite").parquet(f"{work}/{step}")
            return spark.read.parquet(f"{work}/{step}")

        def reached(point: int) -> None:
            status(job_status_rows(good, points=(point,)), f"reached-{point}")

        m = members()             # members first, then the profile base
        m = landed(P.jobs_members(good, m), "members")
        reached(PROGRESS_POINTS[0])
        counts, sizes = P.counted(m, base())
        counts = landed(counts, "counts")
        reached(PROGRESS_POINTS[1])
        compared = landed(P.segment_compare(good, counts, sizes, k), "compared")
        reached(PROGRESS_POINTS[2])
        report_path = f"{out_dir}/reports/batch={batch_id}"
        (P.profile_report(good, counts, sizes, k, compared).withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").parquet(report_path))
        reached(PROGRESS_POINTS[3])
        failed = bad.select("job_id", F.lit("the request names no segment").alias("error"))
        status(job_status_rows(good, spark.read.parquet(report_path), failed, points=()), "finished")
        remove_path(spark, work)
    return run


def start_job_stream(spark: SparkSession, jobs_dir: str, out_dir: str, checkpoint: str,
                     members: Callable[[], DataFrame], base: Callable[[], DataFrame], app: str,
                     available_now: bool = False, files_per_batch: int | None = None,
                     poll: str = "30 seconds") -> StreamingQuery:
    """Start the stream (:func:`crowdscope.streaming.deadlines.run_until` ends a
    polling one at its deadline). ``available_now`` processes what is there and
    stops (tests, scheduled runs); otherwise it polls every ``poll``. The
    stream itself is stateless: what is finished stands in the status table."""
    stream = job_request_stream(spark, jobs_dir, app, files_per_batch)
    writer = (stream.writeStream.foreachBatch(profile_batch_writer(spark, members, base, out_dir))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=poll)
    return writer.start()


def read_reports(spark: SparkSession, out_dir: str) -> DataFrame:
    """Latest report per job across all batches."""
    r = spark.read.parquet(f"{out_dir}/reports")
    return latest_by_key(r, ["job_id"], [F.desc("batch_id")]).drop("batch", "batch_id")


def read_status(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.parquet(f"{out_dir}/status").drop("batch", "step")
