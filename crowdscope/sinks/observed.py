"""Column quality measured by the pass that writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from crowdscope.functions.columns import blank_or_null
from crowdscope.sinks.writers import clustered


def write_with_quality(df: DataFrame, path: str, columns: list[str], uid: str = "uid",
                       partition_by: list[str] | None = None, mode: str = "errorifexists") -> DataFrame:
    """Write ``df`` and return one row of quality: ``rows``, ``users`` and the
    blank-or-null count of each column, as ``column_quality`` gives it.

    The counts are observed in the tasks that write (after the last exchange,
    so a task that ran before an executor was lost isn't counted twice); the
    plan behind ``df`` runs once. Distinct users can't be observed: they are
    counted over the one column ``uid`` of what was written, so the folder
    must be new (``errorifexists``) or replaced (``overwrite``)."""
    if mode not in ("errorifexists", "overwrite"):
        raise ValueError("quality is measured for new or replaced folders")
    seen = Observation()
    laid = clustered(df, partition_by) if partition_by else df
    watched = laid.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(blank_or_null(c)).alias(f"blank_{c}") for c in columns])
    watched.write.mode(mode).partitionBy(*(partition_by or [])).parquet(path)
    found = seen.get
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    return written.agg(F.count_distinct(F.col(uid)).alias("users")).select(
        F.lit(found["rows"]).cast("long").alias("rows"), "users", *[F.lit(found[f"blank_{c}"]).cast("long").alias(c) for c in columns])
