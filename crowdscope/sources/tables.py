"""Table sources."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, base: str, name: str, fmt: str = "parquet",
               options: dict | None = None, schema: str | None = None) -> DataFrame:
    """Any DataFrame source by format name and options (S2, S3). Parquet
    keeps column pruning and predicate pushdown and takes its schema from the
    file footers; text formats should be given ``schema`` (no inference pass
    over the data)."""
    reader = spark.read.format(fmt)
    if schema:
        reader = reader.schema(schema)
    if options:
        reader = reader.options(**options)
    path = base if not name else f"{base.rstrip('/')}/{name}.{fmt}"
    return reader.load(path)


def scan(df: DataFrame, columns: list[str] | None = None, where: Column | str | None = None,
         rename: dict[str, str] | None = None) -> DataFrame:
    """Projected, filtered scan (S1, P1, P2, P8). Catalyst pushes ``where``
    into the parquet reader and prunes the unread columns."""
    if where is not None:
        df = df.filter(where)
    if columns:
        df = df.select(*columns)
    if rename:
        df = df.withColumnsRenamed(rename)
    return df


def _ts(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, dt.date) and not isinstance(v, dt.datetime):
        v = dt.datetime.combine(v, dt.time())
    return F.lit(v).cast("timestamp_ntz")


def time_range(df: DataFrame, ts_col: str, start, end, inclusive_start: bool = False) -> DataFrame:
    """Events in the time-id window ``(start, end]`` at millisecond grain.

    A time-id bound "greater than the largest id of millisecond t" excludes
    that millisecond and "less than the largest id of millisecond t"
    includes it, so the window is ``ts >= start + 1 ms and ts < end + 1 ms``;
    ``inclusive_start`` gives ``ts >= start`` for the ``>=`` variant. Both
    comparisons are on the raw column, so they reach the parquet reader as
    pushed filters.
    """
    one_ms = F.expr("INTERVAL 1 MILLISECOND")
    lo = _ts(start) if inclusive_start else _ts(start) + one_ms
    hi = _ts(end) + one_ms
    c = F.col(ts_col)
    return df.filter((c >= lo) & (c < hi))


def date_range(df: DataFrame, ts_col: str, start, end) -> DataFrame:
    """Half-open date window on ``cast(ts as date)`` (P9); Spark unwraps the
    cast so the filter is still pushed down."""
    d = F.col(ts_col).cast("date")
    return df.filter((d >= F.lit(start).cast("date")) & (d < F.lit(end).cast("date")))
