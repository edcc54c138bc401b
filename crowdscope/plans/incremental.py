"""Retention from a kept state instead of a scan of the whole window.

The state has one row per user and install day (null for other events): the
last date and the last scan day of such events. It merges by maximum, so a day's run
reads that day's events and the state, not the 92 days behind them, and gives
what :func:`crowdscope.plans.retention.daily_retention` gives.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdscope.plans import retention as R
from crowdscope.sources.tables import time_range

STATE = ("uid", "idate", "last", "scan_day")


def scanned_days(events: DataFrame, after, upto, ts_col: str = "ts", install: str = "install") -> DataFrame:
    """State rows of the events in ``(after, upto]`` at millisecond grain. An
    event's scan day is the first day whose midnight is not before it."""
    ev = time_range(events, ts_col, after, upto)
    ts = F.date_trunc("millisecond", F.col(ts_col))
    day = F.to_date(F.col(ts_col))
    scan_day = F.when(ts == F.date_trunc("day", F.col(ts_col)), day).otherwise(F.date_add(day, 1))
    return (ev.groupBy("uid", F.when(F.col("mevent") == install, day).alias("idate"))
            .agg(F.max(day).alias("last"), F.max(scan_day).alias("scan_day")))


def merge_state(state: DataFrame, delta: DataFrame, as_of, days_back: int = 91) -> DataFrame:
    """The state of ``as_of``: both merged, without what left the window. Rows
    are combined before the shuffle; a user keeps one row per install day."""
    start = dt.date.fromisoformat(str(as_of)) - dt.timedelta(days=days_back)
    both = state.select(*STATE).unionByName(delta.select(*STATE))
    return (both.filter(F.col("scan_day") > F.lit(start)).groupBy("uid", "idate")
            .agg(F.max("last").alias("last"), F.max("scan_day").alias("scan_day")))


def retention_of_state(state: DataFrame, members: DataFrame, as_of, days_back: int = 91, windows=R.DEFAULT_WINDOWS,
                       with_timestamp: bool = True) -> DataFrame:
    """Retention per segment from the state of ``as_of``."""
    end = dt.date.fromisoformat(str(as_of))
    start = (end - dt.timedelta(days=days_back)).isoformat()
    return R.retention_of(R.next_installs(state.select("uid", "idate", "last")), members, start, end.isoformat(), windows, with_timestamp)
