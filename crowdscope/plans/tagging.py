"""Interest tagging from the URLs users read.

Plan shape: one scan of the read events, URL sections as column
expressions, and one ``groupBy(uid)`` whose partial (map-side) aggregate
computes every category's count at once, so a user with a third of all
reads costs one bigger partial sum, not a hot task. The long form comes from
``unpivot`` of that one aggregate (not a union re-reading it per category),
and the read total travels along as an id column instead of a join back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdscope.functions import columns as C
from crowdscope.functions.taxonomy import NEWS_TAXONOMY, TAG_RULES, TAGGABLE, Category


def category_shares(events: DataFrame, taxonomy: tuple[Category, ...] = NEWS_TAXONOMY,
                    url_col: str = "aurl", fixed_sections: bool = False) -> DataFrame:
    """Per user, the share of their read events in each category plus
    ``tot_readevent`` (A15, P11). Categories overlap; an event matching a
    category on both sections counts once; a null URL counts in the total
    only. A null ``uid`` forms its own group here."""
    reads = C.with_url_sections(events.filter(F.col("mevent") == "read").select("uid", url_col), url_col,
                                fixed=fixed_sections).select("uid", "col1", "col2")
    total = F.count(F.lit(1))
    aggs = [(F.count_if(cat.matches(F.col("col1"), F.col("col2"))) / total).alias(cat.name) for cat in taxonomy]
    return reads.groupBy("uid").agg(*aggs, total.alias("tot_readevent"))


def unpivot_shares(shares: DataFrame, taxonomy: tuple[Category, ...] = NEWS_TAXONOMY) -> DataFrame:
    """Wide category shares -> ``(uid, tot_readevent, pref_catg, value)``."""
    return shares.unpivot(["uid", "tot_readevent"], [c.name for c in taxonomy], "pref_catg", "value")


def tag_filter(long: DataFrame, taggable=TAGGABLE, rules=TAG_RULES) -> DataFrame:
    """Keep shares that make a tag (P10)."""
    cond = None
    for share, reads, inclusive in rules:
        r = F.col("tot_readevent") >= reads if inclusive else F.col("tot_readevent") > reads
        term = (F.col("value") > share) & r
        cond = term if cond is None else cond | term
    return long.filter(cond & F.col("pref_catg").isin(list(taggable)))


def interest_tags(events: DataFrame, as_of, taxonomy: tuple[Category, ...] = NEWS_TAXONOMY,
                  taggable=TAGGABLE, rules=TAG_RULES, url_col: str = "aurl",
                  fixed_sections: bool = False) -> DataFrame:
    """``(month, year, uid, pref_catg, value, tot_readevent)`` tags.

    The null-``uid`` group is dropped, as the join back in the original job
    dropped it. ``as_of`` replaces "today" so reruns are reproducible."""
    d = F.lit(str(as_of)).cast("date")
    shares = category_shares(events, taxonomy, url_col, fixed_sections).filter(F.col("uid").isNotNull())
    tags = tag_filter(unpivot_shares(shares, taxonomy), taggable, rules)
    return tags.select(F.month(d).alias("month"), F.year(d).alias("year"), "uid", "pref_catg", "value",
                       "tot_readevent")


def with_row_ids(tags: DataFrame) -> DataFrame:
    """Adds ``createdtime``, a time-based UUID per row, and ``created_at``, the
    time it holds (D1). The id is of version 7: 48 bits of milliseconds, then
    74 random bits of the built-in ``uuid()``, so ids sort by time and no
    Python runs per row; :func:`row_id_millis` reads the time back."""
    now = F.current_timestamp()
    ms = F.lpad(F.lower(F.hex(F.unix_millis(now))), 12, "0")
    tail = F.substring(F.expr("uuid()"), 16, 21)  # 12 random bits, variant, 62 random bits
    row_id = F.concat(F.substring(ms, 1, 8), F.lit("-"), F.substring(ms, 9, 4), F.lit("-7"), tail)
    return tags.withColumn("createdtime", row_id).withColumn("created_at", now)


def row_id_millis(row_id: Column) -> Column:
    """Milliseconds since 1970 in a time-based row id."""
    digits = F.concat(F.substring(row_id, 1, 8), F.substring(row_id, 10, 4))
    return F.conv(digits, 16, 10).cast("long")


def daily_tags(events: DataFrame, as_of, days_back: int = 31, taxonomy: tuple[Category, ...] = NEWS_TAXONOMY,
               ts_col: str = "ts", **kw) -> DataFrame:
    """The scheduled tagging job: reads in the time-id window
    ``(as_of - days_back, as_of]`` at millisecond grain (S4), tagged as of
    ``as_of`` (month and year)."""
    from crowdscope.sources.tables import time_range
    import datetime as _dt
    end = _dt.date.fromisoformat(str(as_of))
    scanned = time_range(events, ts_col, end - _dt.timedelta(days=days_back), end)
    return interest_tags(scanned, as_of, taxonomy, **kw)
