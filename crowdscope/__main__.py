"""Scheduled jobs from the command line (``spark-submit`` or ``python -m crowdscope``).

  retention  events + segment members -> one retention row per segment
  tags       read events -> interest tags with row ids
  profiles   profile-request stream (job files in, reports and status rows out)

Retention and tags write their run's date partition; rerunning a day replaces
it (so an orchestrator may retry a failed run), ``--append`` appends instead.

Inputs are any Spark source (``--format``, default parquet). Event columns are
named by options, so the app's own names (``timestamp``, ``mevent``, ``aurl``)
work without renaming the table.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _read(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    from crowdscope.sources.tables import read_table
    return read_table(spark, path, "", fmt)


def _events(spark, a) -> DataFrame:
    e = _read(spark, a.events, a.format)
    if a.app:
        if "appid" not in e.columns:
            raise SystemExit("--app is given, but the events have no appid column")
        e = e.filter(F.col("appid") == a.app)
    cols = {"uid": F.col(a.uid_col), "ts": F.col(a.ts_col), "mevent": F.col(a.event_col)}
    if a.url_col in e.columns:
        cols["aurl"] = F.col(a.url_col)
    return e.select(*[c.alias(n) for n, c in cols.items()])


def _members(spark, a) -> DataFrame:
    from crowdscope.sources.payloads import segment_members
    m = _read(spark, a.members, a.members_format if a.members_format != "payload" else "parquet")
    return segment_members(m) if a.members_format == "payload" else m.select("segment_id", "uid")


def run_retention(spark, a) -> None:
    from crowdscope.plans.retention import daily_retention
    from crowdscope.sinks.writers import write_table
    as_of = a.as_of or (dt.date.today() - dt.timedelta(days=1)).isoformat()
    out = daily_retention(_events(spark, a), _members(spark, a), as_of, a.days_back)
    # a rerun replaces the rows of its own day and app only
    out = out.withColumn("app", F.lit(a.app or "all"))
    write_table(out, a.out, "append" if a.append else "replace_partitions", ["installtodate", "app"])


def run_tags(spark, a) -> None:
    from crowdscope.plans.tagging import daily_tags, with_row_ids
    from crowdscope.sinks.writers import write_table
    as_of = a.as_of or dt.date.today().isoformat()
    out = with_row_ids(daily_tags(_events(spark, a), as_of, a.days_back or 31))
    # a rerun replaces the rows of its own day and app only
    out = out.withColumn("run_date", F.lit(as_of)).withColumn("app", F.lit(a.app or "all"))
    write_table(out, a.out, "append" if a.append else "replace_partitions", ["year", "month", "run_date", "app"])


def run_profiles(spark, a) -> None:
    from crowdscope.plans.profile import profile_base
    from crowdscope.streaming.jobs import start_job_stream
    if not a.app:
        raise SystemExit("profiles needs --app: jobs are taken for one app")

    def own(path):
        df = _read(spark, path, a.format)
        return df.filter(F.col("appid") == a.app) if "appid" in df.columns else df

    def base():
        prices = _read(spark, a.prices, a.format)
        return profile_base(own(a.profiles), own(a.prefs), prices)

    q = start_job_stream(spark, a.jobs_dir, a.out, a.checkpoint, lambda: _members(spark, a), base, a.app,
                         available_now=a.once, files_per_batch=a.files_per_batch)
    q.awaitTermination()


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="crowdscope")
    sub = p.add_subparsers(dest="job", required=True)
    for name in ("retention", "tags", "profiles"):
        s = sub.add_parser(name)
        s.add_argument("--out", required=True)
        s.add_argument("--format", default="parquet")
        s.add_argument("--append", action="store_true",
                       help="append the run's rows; by default a rerun replaces its own date partition")
        s.add_argument("--app", default=None)
        s.add_argument("--as-of", dest="as_of", default=None)
        s.add_argument("--days-back", dest="days_back", type=int, default=91 if name == "retention" else 31)
        s.add_argument("--uid-col", dest="uid_col", default="uid")
        s.add_argument("--ts-col", dest="ts_col", default="timestamp")
        s.add_argument("--event-col", dest="event_col", default="mevent")
        s.add_argument("--url-col", dest="url_col", default="aurl")
        s.add_argument("--members-format", dest="members_format", default="parquet",
                       help="parquet/any source with (segment_id, uid), or 'payload' for (segment_id, payload)")
        if name in ("retention", "tags"):
            s.add_argument("--events", required=True)
        if name in ("retention", "profiles"):
            s.add_argument("--members", required=True)
        if name == "profiles":
            for opt in ("jobs-dir", "profiles", "prefs", "prices", "checkpoint"):
                s.add_argument(f"--{opt}", dest=opt.replace("-", "_"), required=True)
            s.add_argument("--once", action="store_true", help="process the files present, then stop")
            s.add_argument("--files-per-batch", dest="files_per_batch", type=int, default=None)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    if spark is None:
        from crowdscope.session import build_session
        spark = build_session(app=f"crowdscope-{a.job}")
    {"retention": run_retention, "tags": run_tags, "profiles": run_profiles}[a.job](spark, a)


if __name__ == "__main__":
    main(sys.argv[1:])
