"""Aggregations from the interactive notes and daily jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdscope.functions.columns import blank_or_null, event_date


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def conditional_count(df: DataFrame, keys: list, name: str, pred: Column) -> DataFrame:
    """Rows matching ``pred`` per group (A8); a null test counts as no match."""
    return df.groupBy(*keys).agg(F.count_if(pred).alias(name))


def distinct_count(df: DataFrame, column: str, approx: bool = False, rsd: float = 0.01,
                   alias: str = "n_distinct") -> DataFrame:
    """Global distinct count (A4): exact (a partial distinct on the column,
    one shuffle on it, then a one-row merge) or, with ``approx``, a
    HyperLogLog++ sketch merged map-side (no shuffle of the values; relative
    standard deviation ``rsd``)."""
    agg = F.approx_count_distinct(column, rsd) if approx else F.count_distinct(F.col(column))
    return df.agg(agg.alias(alias))


def null_group_count(df: DataFrame, column: str) -> DataFrame:
    """``where(c is null).groupBy(c).count()``."""
    return df.filter(F.col(column).isNull()).groupBy(column).count()


def column_quality(df: DataFrame, columns: list[str], uid: str = "uid") -> DataFrame:
    """One pass: row count, distinct users and the blank-or-null count of each
    column (A20, P17). A single global aggregate; the distinct-user count is
    a partial distinct on ``uid`` followed by a one-row merge."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(F.col(uid)).alias("users"),
                  *[F.count_if(blank_or_null(c)).alias(c) for c in columns])


# --- Fixed values: daily activity counters (name, event test) ---------------
# Each test takes the event-name column.
ACTIVITY_COUNTERS = (
    ("read", lambda m: m == "read"),
    ("notf_del", lambda m: m == "notification_delivered"),
    ("notf_open", lambda m: m == "notification_open"),
    ("pub_change", lambda m: m == "publication_changed"),
    ("videp_pause", lambda m: m == "video/pause"),
    ("video_play", lambda m: m == "video/play"),
    ("shared", lambda m: F.substring(m, 1, 5) == "share"),
    ("setting_chg", lambda m: m == "settings_changed"),
)
# ---------------------------------------------------------------------------


def daily_user_activity(events: DataFrame, counters=ACTIVITY_COUNTERS, install: str = "install") -> DataFrame:
    """Per user and day: ``install`` flag and, per counter, the number of
    distinct event ids matching it (C8, A9, A10, A18).

    Exact ``count(distinct case when p then eventid end)`` for eight
    predicates, without Spark's 8-way ``Expand``: first one row per
    ``(uid, date, eventid)`` with a flag per counter (partial aggregate, and
    the shuffle key includes the event id, so a very active user-day is
    spread over many tasks), then a plain sum per ``(uid, date)``.
    """
    day = event_date("timestamp").alias("date")
    m = F.col("mevent")
    flags = [F.max(F.when(test(m), 1).otherwise(0)).alias(name) for name, test in counters]
    per_event = (events.groupBy("uid", day, "eventid")
                 .agg(F.max(F.when(F.col("mevent") == install, 1).otherwise(0)).alias("install"), *flags))
    has_id = F.col("eventid").isNotNull()
    return (per_event.groupBy("uid", "date")
            .agg(F.max("install").alias("install"),
                 *[F.sum(F.when(has_id, F.col(name)).otherwise(0)).alias(name) for name, _ in counters]))


def crosstab_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    """Contingency table in long form (A13): one row per pair of values that
    occurs, nulls being a value, for any number of values."""
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


#: Most columns that a contingency table finds by itself.
MAX_CROSSTAB_COLUMNS = 1000


def crosstab(df: DataFrame, a: str, b: str, values: list | None = None) -> DataFrame:
    """Contingency table in wide form (A13): a column per value of ``b`` and a
    row per value of ``a`` (a null one reads ``null``, on either side).

    With ``values`` no job runs to find the columns and their number has no
    limit. Without, the values that occur are looked up first, in order; more
    than ``MAX_CROSSTAB_COLUMNS`` are an error, as such a table is one for
    :func:`crosstab_counts`."""
    if values is None:
        found = df.select(b).distinct().limit(MAX_CROSSTAB_COLUMNS + 1).collect()
        if len(found) > MAX_CROSSTAB_COLUMNS:
            raise ValueError(f"more than {MAX_CROSSTAB_COLUMNS} values of {b}: use crosstab_counts")
        values = sorted((r[0] for r in found), key=lambda v: (v is None, v if v is not None else 0))
    name = F.coalesce(F.col(a).cast("string"), F.lit("null")).alias(f"{a}_{b}")
    return df.groupBy(name).agg(*[F.count_if(F.col(b).isNull() if v is None else F.col(b) == v)
                                  .alias("null" if v is None else str(v)) for v in values])


def pivot_sum(df: DataFrame, keys: list[str], pivot: str, measure: str, values: list | None = None,
              decimals: int | None = None) -> DataFrame:
    """``groupBy(keys).pivot(pivot, values).sum(measure)`` (A12). Passing
    ``values`` skips the extra job that discovers them."""
    agg = F.sum(measure)
    if decimals is not None:
        agg = F.round(agg, decimals)
    return df.groupBy(*keys).pivot(pivot, values).agg(agg)


def daily_count(df: DataFrame, ts: str, column: str) -> DataFrame:
    """``groupby(ts.cast('date')).agg({column: 'count'})``."""
    out = df.groupBy(F.col(ts).cast("date").alias("day")).agg({column: "count"})
    return out.withColumnRenamed(f"count({column})", "n_events")
