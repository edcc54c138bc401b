"""Install-cohort retention per audience segment.

Input events have ``uid``, a date column ``d`` and an event name ``mevent``;
members are ``(segment_id, uid)`` rows, any number of segments.

A user installing on ``idate`` is *lost* for window ``n`` days when their last
activity falls before ``idate + n`` or when they installed again strictly
between ``idate`` and ``idate + n``. Retention for window ``n`` is kept users
over all users, counted only over cohorts whose window has fully elapsed
(``idate + n <= as_of``), in numerator and denominator alike.

Plan shape (no per-segment loop, no fan-out join, one pass over events):
  * one hash aggregate over the events, keyed by user and install day (null
    for other events), keeps the last date of each. Its partial side leaves a
    task at most one row per user and install day, so a user with a third of
    all events costs a few rows per map task, and no task sorts raw events.
    The events table, the largest input, is scanned once;
  * one window per user over those few rows (at most the days scanned, plus
    one) gives each install day the next one and the user's last date;
  * members are de-duplicated (partial aggregate first, so a member repeated
    millions of times is collapsed before the shuffle) and joined on ``uid``;
    the per-user side is already hash-partitioned on ``uid``;
  * one aggregation per segment computes every window's ratio directly from
    ``(segment, user, cohort)`` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crowdscope.operators.hotkeys import HOT_ROWS, interval_join

# Window names and lengths in days.
DEFAULT_WINDOWS = (("w2", 7), ("w3", 14), ("w4", 21), ("m2", 30), ("m3", 60), ("m4", 90))


def _date(v) -> Column:
    return v if isinstance(v, Column) else F.lit(str(v)).cast("date")


def user_summary(events: DataFrame, install: str = "install") -> DataFrame:
    """Per user and distinct install date: ``(uid, idate, next_install,
    maxtime)``, ``maxtime`` being the user's last active date (A7). Users with
    other events have a further row whose ``idate`` is null."""
    return next_installs(events.groupBy("uid", F.when(F.col("mevent") == install, F.col("d")).alias("idate"))
                         .agg(F.max("d").alias("last")))


def next_installs(days: DataFrame) -> DataFrame:
    """The next install and the user's last date beside each of the ``(uid,
    idate, last)`` rows."""
    user = Window.partitionBy("uid").orderBy("idate")
    whole = user.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return days.select("uid", "idate", F.lead("idate").over(user).alias("next_install"),
                       F.max("last").over(whole).alias("maxtime"))


def _cohorts(summary: DataFrame, start, as_of) -> DataFrame:
    """``(uid, idate, next_install, maxtime)`` for installs dated in
    ``[start, as_of]``; ``next_install`` is the next install over *all*
    scanned installs, so a re-install after ``as_of`` still counts."""
    return summary.filter(F.col("idate").between(_date(start), _date(as_of)))


def install_cohorts(events: DataFrame, start, as_of, install: str = "install") -> DataFrame:
    """``(uid, idate, next_install)`` for installs dated in ``[start, as_of]``."""
    return _cohorts(user_summary(events, install), start, as_of).drop("maxtime")


def last_activity(events: DataFrame) -> DataFrame:
    """Last active date per user."""
    return events.groupBy("uid").agg(F.max("d").alias("maxtime"))


def segment_users(members: DataFrame) -> DataFrame:
    """Distinct ``(segment_id, uid)``; membership lists may repeat ids."""
    return members.select("segment_id", "uid").distinct()


def cohort_users(events: DataFrame, members: DataFrame, start, as_of) -> DataFrame:
    """Members who installed in the range: ``(segment_id, uid, idate)``."""
    cohorts = install_cohorts(events, start, as_of).select("uid", "idate")
    return segment_users(members).join(cohorts, "uid").select("segment_id", "uid", "idate")


def _lost(n: int) -> Column:
    limit = F.date_add(F.col("idate"), n)
    return (F.coalesce(F.col("maxtime") < limit, F.lit(False))
            | F.coalesce(F.col("next_install") < limit, F.lit(False)))


def reinstall_within(events: DataFrame, start, as_of, windows=DEFAULT_WINDOWS) -> DataFrame:
    """Per install cohort, whether the user was lost in each window:
    ``(uid, idate, next_install, maxtime, lost_<name>...)`` (J5, J6, W2)."""
    rows = _cohorts(user_summary(events), start, as_of)
    return rows.select("uid", "idate", "next_install", "maxtime",
                       *[_lost(n).alias(f"lost_{name}") for name, n in windows])


def active_within(events: DataFrame, start, as_of, windows=DEFAULT_WINDOWS, width: int = 32,
                  hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per install cohort, whether the user had any event after the install
    day and inside each window: ``(uid, idate, active_<name>...)`` (J6). Events
    count once a user and day, combined before the shuffle; days and cohorts
    meet in an interval join over bins of ``width`` days."""
    cohorts = install_cohorts(events, start, as_of).select("uid", "idate").distinct()
    last = max(n for _, n in windows)
    spans = cohorts.select("uid", "idate", (F.unix_date("idate") + 1).alias("_from"), (F.unix_date("idate") + last).alias("_to"))
    days = events.select("uid", F.unix_date("d").alias("_day")).distinct()
    pairs = interval_join(days, spans, ["uid"], "_day", "_from", "_to", width, hot_rows).select("uid", "idate", "_day")
    every = pairs.unionByName(cohorts, allowMissingColumns=True)
    return every.groupBy("uid", "idate").agg(*[
        F.coalesce(F.max(F.col("_day") < F.unix_date("idate") + n), F.lit(False)).alias(f"active_{name}") for name, n in windows])


def retention(events: DataFrame, members: DataFrame, start, as_of,
              windows=DEFAULT_WINDOWS, with_timestamp: bool = True) -> DataFrame:
    """One row per segment: ``installfromdate, installtodate,
    [lastupdatedtime,] <window ratios>..., segment`` (C1, A14, A19)."""
    return retention_of(user_summary(events), members, start, as_of, windows, with_timestamp)


def retention_of(summary: DataFrame, members: DataFrame, start, as_of, windows=DEFAULT_WINDOWS,
                 with_timestamp: bool = True) -> DataFrame:
    """:func:`retention` from the rows of :func:`user_summary`."""
    as_of_d = _date(as_of)
    cohorts = _cohorts(summary, start, as_of)
    # members without installs keep their segment (a row with null idate)
    rows = segment_users(members).join(cohorts, "uid", "left")
    aggs = []
    for name, n in windows:
        due = F.date_add(F.col("idate"), n) <= as_of_d
        kept = F.count_if(due & ~_lost(n))
        users = F.count_if(due)
        aggs.append(F.try_divide(kept, users).alias(name))
    per_segment = rows.groupBy("segment_id").agg(*aggs)
    head = [F.lit(str(start)).alias("installfromdate"), F.lit(str(as_of)).alias("installtodate")]
    if with_timestamp:
        head.append(F.current_timestamp().alias("lastupdatedtime"))
    return per_segment.select(*head, *[name for name, _ in windows],
                              F.col("segment_id").alias("segment"))


def daily_retention(events: DataFrame, members: DataFrame, as_of, days_back: int = 91,
                    windows=DEFAULT_WINDOWS, ts_col: str = "ts") -> DataFrame:
    """The scheduled job: events with a timestamp ``ts`` are scanned in the
    time-id window ``(as_of - days_back, as_of]`` at millisecond grain (S4,
    Q2), dated by ``cast(ts as date)`` (Q23), and cohorts run from
    ``as_of - days_back`` to ``as_of`` (Q3: yesterday and 92 days back in
    the original schedule, i.e. ``as_of`` = yesterday, ``days_back`` = 91)."""
    from crowdscope.sources.tables import time_range
    import datetime as _dt
    end = _dt.date.fromisoformat(str(as_of))
    start = end - _dt.timedelta(days=days_back)
    scanned = time_range(events, ts_col, start, end)
    ev = scanned.select("uid", F.to_date(F.col(ts_col)).alias("d"), "mevent")
    return retention(ev, members, start.isoformat(), end.isoformat(), windows)
