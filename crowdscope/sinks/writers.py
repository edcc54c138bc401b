"""Sinks (K1-K8).

Keyed tables are written as new versions (write-then-read), never by
overwriting a path that the same plan reads from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def key_bucket(cols: list[str], buckets: int) -> Column:
    """Stable hash bucket of wide keys (such as ``uid``) so a partitioned
    table gets ``buckets`` directories instead of one per key (K3)."""
    return F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(buckets)).cast("int")


def clustered(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows grouped by ``cols`` for the writer, so that each task writes few
    directories. AQE splits a partition above the advisory size over several
    tasks and merges small ones, so a hot directory is written in parallel."""
    return df.hint("rebalance", *[F.col(c) for c in cols])


def write_table(df: DataFrame, path: str, mode: str = "append", partition_by: list[str] | None = None,
                bucket_keys: list[str] | None = None, buckets: int = 64, fmt: str = "parquet",
                columns: list[str] | None = None) -> None:
    """Append (K1), fail-if-exists (K2, ``mode='errorifexists'``),
    partitioned create (K3), chosen columns (K5), parquet (K6).

    ``mode='replace_partitions'`` overwrites only the partitions present in
    ``df`` (dynamic partition overwrite): a rerun of the same day replaces
    that day instead of appending it twice."""
    if columns:
        df = df.select(*columns)
    parts = list(partition_by or [])
    if bucket_keys:
        df = df.withColumn("key_bucket", key_bucket(bucket_keys, buckets))
        parts.append("key_bucket")
    dynamic = mode == "replace_partitions"
    if dynamic and not parts:
        raise ValueError("replace_partitions needs partition columns")
    if parts:
        df = clustered(df, parts)
    w = df.write.mode("overwrite" if dynamic else mode).format(fmt)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    if parts:
        w = w.partitionBy(*parts)
    w.save(path)


def save_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int, sort: bool = True,
                  mode: str = "errorifexists") -> None:
    """Save ``df`` as a catalog table hash-bucketed (and sorted) by ``keys``
    (K3 co-location). Aggregations and joins keyed by a superset of
    ``keys`` then read the buckets as already partitioned and skip the
    shuffle: per-user retention summaries and daily activity on an events
    table bucketed by ``uid`` run without any exchange of event rows."""
    w = df.write.mode(mode).format("parquet").bucketBy(buckets, *keys)
    if sort:
        w = w.sortBy(*keys)
    w.saveAsTable(table)


def latest_by_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row per key: the first by ``order`` (e.g. newest write) (K4).

    ``row_number() == 1`` becomes a per-group limit of 1 applied before the
    shuffle, so a key written a million times sends one row per map task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def upsert(current: DataFrame, updates: DataFrame, keys: list[str], version_col: str = "written_at",
           tiebreak: list | None = None) -> DataFrame:
    """Keyed upsert: union the stored rows with the new ones and keep the
    newest per key, as a store with a primary key does (K4). Write the
    result as a new table version."""
    order = [F.desc(version_col)] + list(tiebreak or [])
    return latest_by_key(current.unionByName(updates, allowMissingColumns=True), keys, order)


def upsert_table(updates: DataFrame, path: str, keys: list[str], version_col: str = "written_at",
                 tiebreak: list | None = None, buckets: int = 256, staging: str | None = None) -> None:
    """Incremental keyed upsert into a table stored at ``path``, partitioned
    by a hash bucket of ``keys`` (K4 at scale).

    The updates are landed first; the bucket ids they touch (at most
    ``buckets`` numbers) then prune the stored table by a plain partition
    filter, whatever the updates were read from. The merged buckets are
    written to ``staging`` in the shared folder, swapped in with dynamic
    partition overwrite, and the staged copy is removed. The first call
    creates the table.

    One writer at a time. A reader that lists the table during the swap can
    see some buckets before and some after the update.
    """
    from crowdscope.session import path_exists, remove_path, scratch_path
    spark = updates.sparkSession
    new = updates.withColumn("key_bucket", key_bucket(keys, buckets))
    order = [F.desc(version_col)] + list(tiebreak or [])
    if not path_exists(spark, path):
        merged = latest_by_key(new, keys, order)
        clustered(merged, ["key_bucket"]).write.mode("errorifexists").partitionBy("key_bucket").parquet(path)
        return
    stage = staging or scratch_path(spark, "upsert-stage")
    landed, swapped = f"{stage}/updates", f"{stage}/merged"
    latest_by_key(new, keys, order).write.mode("errorifexists").parquet(landed)
    new = spark.read.parquet(landed)
    touched = [r.key_bucket for r in new.select("key_bucket").distinct().collect()]
    current = spark.read.parquet(path).filter(F.col("key_bucket").isin(touched))
    merged = latest_by_key(current.unionByName(new, allowMissingColumns=True), keys, order)
    merged.write.mode("errorifexists").parquet(swapped)
    (clustered(spark.read.parquet(swapped), ["key_bucket"]).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("key_bucket").parquet(path))
    remove_path(spark, stage)


# --- Fixed values: job progress points (percent) ---------------------------
PROGRESS_POINTS = (20, 40, 60, 80)
# ---------------------------------------------------------------------------


def job_status_rows(jobs: DataFrame, reports: DataFrame | None = None, failed: DataFrame | None = None,
                    points: tuple[int, ...] = (0,) + PROGRESS_POINTS) -> DataFrame:
    """Status events per job (K8): ``EXECUTING`` at each of ``points`` (percent), then ``SUCCESS`` at 100 with the report as ``payload`` (a JSON
    document whose ``response.result`` fields hold the report arrays as JSON
    strings). ``failed`` jobs (``job_id``, ``error``) get a ``FAILED`` row.
    """
    now_ms = F.unix_millis(F.current_timestamp())
    steps = F.array(*[F.lit(p) for p in points]).cast("array<int>")
    running = jobs.select("job_id", F.explode(steps).alias("completion_pct")).select(
        "job_id", F.lit("EXECUTING").alias("status"), "completion_pct", now_ms.alias("event_ms"),
        F.to_json(F.struct(F.col("job_id").alias("id"), F.lit("EXECUTING").alias("status"),
                           F.when(F.col("completion_pct") == 0, now_ms).alias("startTime"),
                           F.when(F.col("completion_pct") > 0, F.col("completion_pct")).alias("completionPercentage"),
                           F.struct(F.lit("null").alias("result")).alias("response"))).alias("payload"))
    out = running if points else running.limit(0)
    if reports is not None:
        done = reports.select(
            "job_id", F.lit("SUCCESS").alias("status"), F.lit(100).alias("completion_pct"), now_ms.alias("event_ms"),
            F.to_json(F.struct(F.col("job_id").alias("id"), F.lit("SUCCESS").alias("status"),
                               F.lit(100).alias("completionPercentage"), now_ms.alias("endTime"),
                               F.struct("result", "result_compare").alias("response"))).alias("payload"))
        out = out.unionByName(done)
    if failed is not None:
        bad = failed.select(
            "job_id", F.lit("FAILED").alias("status"), F.lit(None).cast("int").alias("completion_pct"),
            now_ms.alias("event_ms"),
            F.to_json(F.struct(F.col("job_id").alias("id"), F.lit("FAILED").alias("status"),
                               F.struct(F.col("error").alias("result")).alias("response"))).alias("payload"))
        out = out.unionByName(bad)
    return out
