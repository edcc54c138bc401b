"""JSON payload sources: segment member lists (S7) and job requests.

Payloads are rows of a DataFrame, never strings on the driver, so any number
of segments or jobs is parsed in one distributed pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

JOB_PAYLOAD_SCHEMA = (
    "response array<struct<jobId: double, jobStatus: string, "
    "inputData: map<string, string>, requested_at: timestamp>>"
)


def segment_members(payloads: DataFrame, text_col: str = "payload", segment_col: str = "segment_id",
                    key: str = "users") -> DataFrame:
    """``(segment_id, payload)`` rows holding ``{"users": [id, ...]}`` ->
    one ``(segment_id, uid)`` row per listed id (S7).

    Ids may be quoted or bare; both come back as text. Duplicates are kept
    (the share denominator counts them). A payload that does not parse gives
    no rows; :func:`segment_payload_rejects` counts those.

    One payload line is read by one task, so a caller joining the result on
    ``uid`` gets a hash shuffle that spreads a very long list over all tasks.
    """
    parsed = payloads.select(
        F.col(segment_col).alias("segment_id"),
        F.from_json(F.col(text_col), f"`{key}` array<string>").getField(key).alias("_ids"))
    return parsed.select("segment_id", F.explode("_ids").alias("uid"))


def segment_payload_rejects(payloads: DataFrame, text_col: str = "payload",
                            segment_col: str = "segment_id", key: str = "users") -> DataFrame:
    """Per segment, the number of payload rows without a readable id list."""
    ids = F.from_json(F.col(text_col), f"`{key}` array<string>").getField(key)
    return (payloads.groupBy(F.col(segment_col).alias("segment_id"))
            .agg(F.count_if(ids.isNull()).alias("rejected_payloads")))


def job_requests(payloads: DataFrame, text_col: str = "payload") -> DataFrame:
    """Job queue responses -> one row per job (S8, F18, F21):
    ``job_id int, job_status, segment_id, app, segment_compare, requested_at``."""
    jobs = payloads.select(F.explode(F.from_json(F.col(text_col), JOB_PAYLOAD_SCHEMA)
                                     .getField("response")).alias("j"))
    data = F.col("j.inputData")
    return jobs.select(
        F.col("j.jobId").cast("int").alias("job_id"),
        F.col("j.jobStatus").alias("job_status"),
        data["segmentid"].alias("segment_id"),
        data["app"].alias("app"),
        data["segmentid_compare"].alias("segment_compare"),
        F.col("j.requested_at").alias("requested_at"),
    )


def submitted_jobs(jobs: DataFrame, app: str, status: str = "SUBMITTED") -> DataFrame:
    """Jobs waiting to run for one app."""
    return jobs.filter((F.col("job_status") == status) & (F.col("app") == app))
