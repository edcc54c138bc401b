"""The query catalog: one registered query per operator of the inventory,
each with its DuckDB oracle SQL where one exists."""

from __future__ import annotations

from pyspark.sql import functions as F

from crowdscope.functions.taxonomy import NEWS_TAXONOMY, TAG_RULES, TAGGABLE
from crowdscope.plans import inputs as I
from crowdscope.plans import retention as R
from crowdscope.plans.inputs import Tables, with_ctes
from crowdscope.plans.profile import FEATURES
from crowdscope.registry import ORACLE, register

# ------------------------------------------------------------------ retention

_RET_WINDOWS = R.DEFAULT_WINDOWS


def _sql_retention(ev: str = I.SQL_EV, members: str = I.SQL_MEMBERS, start: str = I.RET_START,
                   as_of: str = I.RET_AS_OF) -> str:
    """Independent formulation: one row per (segment, user, install day);
    a re-install inside the window is a correlated EXISTS."""
    lost = ",\n    ".join(
        f"(coalesce(ls.last_day < ch.idate + {n}, false) OR EXISTS (SELECT 1 FROM inst x WHERE x.uid = ch.uid "
        f"AND x.d > ch.idate AND x.d < ch.idate + {n})) AS lost_{name}" for name, n in _RET_WINDOWS)
    ratio = ",\n    ".join(
        f"count(*) FILTER (WHERE due_{name} AND NOT lost_{name}) / "
        f"nullif(count(*) FILTER (WHERE due_{name}), 0) AS {name}" for name, _ in _RET_WINDOWS)
    due = ", ".join(f"idate + {n} <= DATE '{as_of}' AS due_{name}" for name, n in _RET_WINDOWS)
    names = ", ".join(f"per_seg.{name}" for name, _ in _RET_WINDOWS)
    return with_ctes(
        ev, members,
        "inst AS (SELECT DISTINCT uid, d FROM ev WHERE mevent = 'install')",
        f"ch AS (SELECT uid, d AS idate FROM inst WHERE d BETWEEN DATE '{start}' AND DATE '{as_of}')",
        "ls AS (SELECT uid, max(d) AS last_day FROM ev GROUP BY uid)",
        f"flags AS (SELECT sm.segment_id, ch.idate, {due},\n    {lost}\n"
        "  FROM (SELECT DISTINCT segment_id, uid FROM members) sm JOIN ch ON sm.uid = ch.uid "
        "LEFT JOIN ls ON ls.uid = ch.uid)",
        f"per_seg AS (SELECT segment_id,\n    {ratio}\n  FROM flags GROUP BY segment_id)",
        body=f"SELECT '{start}' AS installfromdate, '{as_of}' AS installtodate, {names}, "
             "segs.segment_id AS segment FROM (SELECT DISTINCT segment_id FROM members) segs "
             "LEFT JOIN per_seg ON segs.segment_id = per_seg.segment_id")


@register("retention", _sql_retention())
def q_retention(spark, sf):
    t = Tables(spark, sf)
    return R.retention(I.retention_events(t), I.members(t), I.RET_START, I.RET_AS_OF, with_timestamp=False)


def _sql_daily_retention() -> str:
    import datetime as dt
    end = dt.date.fromisoformat(I.EVENTS_AS_OF)
    start = (end - dt.timedelta(days=91)).isoformat()
    ev = (f"ev AS (SELECT user_id AS uid, CAST(ts AS DATE) AS d, CASE WHEN event_type = 'signup' THEN 'install' "
          f"ELSE event_type END AS mevent FROM events WHERE ts >= TIMESTAMP '{start}' + INTERVAL 1 MILLISECOND "
          f"AND ts < TIMESTAMP '{I.EVENTS_AS_OF}' + INTERVAL 1 MILLISECOND)")
    members = "members AS (SELECT lower(c_mktsegment) AS segment_id, c_custkey AS uid FROM customer)"
    return _sql_retention(ev, members, start, I.EVENTS_AS_OF)


@register("retention_daily_window", _sql_daily_retention())
def q_retention_daily_window(spark, sf):
    t = Tables(spark, sf)
    members = t.customer.select(F.lower("c_mktsegment").alias("segment_id"), F.col("c_custkey").alias("uid"))
    df = R.daily_retention(I.app_signups(t), members, I.EVENTS_AS_OF)
    return df.drop("lastupdatedtime")


# ------------------------------------------------------------- shared SQL --

def sql_url_sections(u: str) -> tuple[str, str]:
    """DuckDB form of :func:`crowdscope.functions.columns.url_sections`."""
    parts = f"string_split({u}, '/')"
    n = f"(len({parts}) - 1)"
    j = f"len(string_split(substr({u}, 1, 7), '/'))"
    s1 = (f"CASE WHEN {u} IS NULL THEN NULL WHEN {n} >= {j} + 1 THEN ({parts})[{j} + 1] "
          f"WHEN {n} = {j} THEN '' WHEN {n} >= 1 THEN ({parts})[1] ELSE '' END")
    s2 = (f"CASE WHEN {u} IS NULL THEN NULL WHEN {n} >= {j} + 2 THEN ({parts})[{j} + 2] "
          f"WHEN {n} = {j} + 1 THEN '' WHEN {n} = {j} THEN ({parts})[1] WHEN {n} >= 2 THEN ({parts})[2] "
          f"ELSE '' END")
    return f"lower(trim({s1}))", f"lower(trim({s2}))"


SQL_PBASE = f"""pbase AS (
  SELECT p.uid, p.asource, p.aversion, p.localecity, p.osversion, p.scresolution, p.dtype, p.idate,
         {I.sql_device_key('p.dtype')} AS dtype2, d.price, d.price_range, f.channelids, f.languages
  FROM profiles p LEFT JOIN prefs f ON p.uid = f.uid
  LEFT JOIN deviceprice d ON {I.sql_device_key('p.dtype')} = d.id)"""

_BASE_CTES = (I.SQL_PROFILES, I.SQL_PREFS, I.SQL_DEVICEPRICE, SQL_PBASE)

#: SQL of the computed features; the others are columns of the same name.
_FEATURE_SQL = {"install_day": "dayname(try_strptime(idate, '%d-%m-%Y'))",
                "Device_brand": I.sql_device_brand("dtype"), "device_price": "price_range"}


def _sql_long(base: str = "pbase") -> str:
    scalars = " UNION ALL ".join(
        f"SELECT segment_id, uid, '{fid}' AS feature, {_FEATURE_SQL.get(fid, fid)} AS value FROM rj"
        for fid, _ in FEATURES if fid != "Publication")
    return f"""rj AS (
  SELECT r.segment_id, pb.* FROM (SELECT DISTINCT segment_id, uid AS member_uid FROM members) r
  LEFT JOIN {base} pb ON r.member_uid = pb.uid),
long AS (
  {scalars}
  UNION ALL SELECT segment_id, uid, 'Publication', v FROM (
    SELECT segment_id, uid, unnest(string_split(channelids, ',')) AS v FROM rj WHERE channelids IS NOT NULL)),
sizes AS (SELECT segment_id, count(*) AS n FROM members GROUP BY segment_id),
shares AS (
  SELECT l.segment_id, l.feature, coalesce(l.value, 'Not_Available') AS feature_values,
         count(DISTINCT l.uid) / s.n AS perc_users
  FROM long l JOIN sizes s ON l.segment_id = s.segment_id
  GROUP BY l.segment_id, l.feature, coalesce(l.value, 'Not_Available'), s.n),
top AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY segment_id, feature
                                    ORDER BY perc_users DESC, feature_values) AS INTEGER) AS rank
  FROM shares)"""


SQL_LONG = _sql_long()

SQL_SUBMITTED = f"sjobs AS (SELECT * FROM jobs WHERE job_status = 'SUBMITTED' AND app = '{I.APP}')"


def _t(spark, sf) -> Tables:
    return Tables(spark, sf)


@I.derived
def _base(t: Tables):
    from crowdscope.plans import profile as P
    return P.profile_base(I.profiles(t), I.preferences(t), I.device_prices(t))


@I.derived
def _jobs(t: Tables):
    from crowdscope.sources import payloads as S
    return S.submitted_jobs(S.job_requests(I.job_payloads(t)), I.APP)


# ----------------------------------------------------- scans and simple aggs --

@register("scan_project_filter",
          "SELECT event_id, user_id, event_type, value * 10 AS value_x10 FROM events WHERE event_type = 'view'")
def q_scan_project_filter(spark, sf):
    from crowdscope.sources.tables import scan
    e = _t(spark, sf).events
    return scan(e, ["event_id", "user_id", "event_type", (F.col("value") * 10).alias("value_x10")],
                where=F.col("event_type") == "view")


@register("count_rows", "SELECT count(*) AS n_rows FROM events")
def q_count_rows(spark, sf):
    return _t(spark, sf).events.agg(F.count(F.lit(1)).alias("n_rows"))


@register("sum_column", "SELECT round(sum(value), 2) AS sum_value FROM events")
def q_sum_column(spark, sf):
    return _t(spark, sf).events.agg(F.round(F.sum("value"), 2).alias("sum_value"))


@register("min_max_time", "SELECT min(ts) AS min_ts, max(ts) AS max_ts FROM events")
def q_min_max_time(spark, sf):
    return _t(spark, sf).events.agg(F.min("ts").alias("min_ts"), F.max("ts").alias("max_ts"))


@register("distinct_users", "SELECT count(DISTINCT user_id) AS n_users FROM events")
def q_distinct_users(spark, sf):
    from crowdscope.operators.aggregates import distinct_count
    return distinct_count(_t(spark, sf).events, "user_id", alias="n_users")


@register("events_time_range",
          f"SELECT event_id, user_id, event_type, ts FROM events "
          f"WHERE ts >= TIMESTAMP '{I.EVENTS_TS_START}' + INTERVAL 1 MILLISECOND "
          f"AND ts < TIMESTAMP '{I.EVENTS_TS_END}' + INTERVAL 1 MILLISECOND")
def q_events_time_range(spark, sf):
    from crowdscope.sources.tables import time_range
    e = _t(spark, sf).events
    return time_range(e, "ts", I.EVENTS_TS_START, I.EVENTS_TS_END).select("event_id", "user_id", "event_type", "ts")


@register("events_date_range",
          "SELECT event_id, user_id, ts FROM events "
          "WHERE CAST(ts AS DATE) >= DATE '2024-01-05' AND CAST(ts AS DATE) < DATE '2024-01-12'")
def q_events_date_range(spark, sf):
    from crowdscope.sources.tables import date_range
    return date_range(_t(spark, sf).events, "ts", "2024-01-05", "2024-01-12").select("event_id", "user_id", "ts")


@register("rename_columns",
          'SELECT event_id AS eventid, user_id AS uid, ts AS "timestamp", event_type AS mevent, value AS dataused '
          "FROM events")
def q_rename_columns(spark, sf):
    e = _t(spark, sf).events
    return e.select("event_id", "user_id", "ts", "event_type", "value").toDF(
        "eventid", "uid", "timestamp", "mevent", "dataused")


@register("literal_column",
          "SELECT event_id, 'news_app' AS appid, DATE '2024-01-31' AS as_of_date FROM events")
def q_literal_column(spark, sf):
    e = _t(spark, sf).events.select("event_id")
    return e.withColumn("appid", F.lit(I.APP)).withColumn("as_of_date", F.lit("2024-01-31").cast("date"))


@register("derived_prefix", "SELECT event_id, event_type, substr(event_type, 1, 3) AS mevent2 FROM events")
def q_derived_prefix(spark, sf):
    e = _t(spark, sf).events.select("event_id", "event_type")
    return e.withColumn("mevent2", F.substring("event_type", 1, 3))


@register("group_count", "SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def q_group_count(spark, sf):
    return _t(spark, sf).events.groupBy("event_type").count()


@register("daily_event_count",
          "SELECT CAST(ts AS DATE) AS day, count(user_id) AS n_events FROM events GROUP BY CAST(ts AS DATE)")
def q_daily_event_count(spark, sf):
    from crowdscope.operators.aggregates import daily_count
    return daily_count(_t(spark, sf).events, "ts", "user_id")


@register("last_activity",
          "SELECT user_id AS uid, max(CAST(ts AS DATE)) AS maxtime FROM events GROUP BY user_id")
def q_last_activity(spark, sf):
    e = _t(spark, sf).events.select(F.col("user_id").alias("uid"), F.to_date("ts").alias("d"))
    return R.last_activity(e)


_SQL_COND = "SELECT uid, count(*) FILTER (WHERE mevent = 'read') AS read FROM app_events GROUP BY uid"


@register("conditional_sum", with_ctes(I.SQL_APP_EVENTS, body=_SQL_COND))
def q_conditional_sum(spark, sf):
    from crowdscope.operators.aggregates import conditional_count
    ev = I.app_events(_t(spark, sf))
    return conditional_count(ev, ["uid"], "read", F.col("mevent") == "read")


@register("sql_conditional_sum", with_ctes(I.SQL_APP_EVENTS, body=_SQL_COND))
def q_sql_conditional_sum(spark, sf):
    I.app_events(_t(spark, sf)).createOrReplaceTempView("app_events")
    return spark.sql("SELECT uid, count_if(mevent = 'read') AS read FROM app_events GROUP BY uid")


@register("distinct_rows", "SELECT DISTINCT user_id, event_type FROM events")
def q_distinct_rows(spark, sf):
    return _t(spark, sf).events.select("user_id", "event_type").distinct()


# ------------------------------------------------------------------ quality --

@register("null_group_count",
          with_ctes(I.SQL_GAPS, body="SELECT mevent, count(*) AS count FROM gaps WHERE mevent IS NULL GROUP BY mevent"))
def q_null_group_count(spark, sf):
    from crowdscope.operators.aggregates import null_group_count
    return null_group_count(I.events_with_gaps(_t(spark, sf)), "mevent")


@register("null_fill", with_ctes(I.SQL_GAPS, body="SELECT event_id, coalesce(mevent, 'e') AS mevent FROM gaps"))
def q_null_fill(spark, sf):
    return I.events_with_gaps(_t(spark, sf)).na.fill("e", ["mevent"]).select("event_id", "mevent")


@register("nan_filter", with_ctes(I.SQL_GAPS, body="SELECT event_id, uid FROM gaps WHERE isnan(value)"))
def q_nan_filter(spark, sf):
    g = I.events_with_gaps(_t(spark, sf))
    return g.filter(F.isnan("value")).select("event_id", "uid")


@register("column_quality", with_ctes(I.SQL_GAPS, body=(
    'SELECT count(*) AS "rows", count(DISTINCT uid) AS users, '
    "count(*) FILTER (WHERE coalesce(mevent, '') = '') AS mevent, "
    "count(*) FILTER (WHERE coalesce(props, '') = '') AS props FROM gaps")))
def q_column_quality(spark, sf):
    from crowdscope.operators.aggregates import column_quality
    return column_quality(I.events_with_gaps(_t(spark, sf)), ["mevent", "props"])


@register("column_quality_all", with_ctes(I.SQL_GAPS, I.SQL_RECORDS, body=(
    'SELECT count(*) AS "rows", count(DISTINCT uid) AS users, '
    + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL OR {c} = '') AS {c}" for c in I.QUALITY_COLUMNS)
    + " FROM records")))
def q_column_quality_all(spark, sf):
    from crowdscope.operators.aggregates import column_quality
    return column_quality(I.event_records(_t(spark, sf)), list(I.QUALITY_COLUMNS))


def _sql_daily_activity() -> str:
    tests = [("read", "mevent = 'read'"), ("notf_del", "mevent = 'notification_delivered'"),
             ("notf_open", "mevent = 'notification_open'"), ("pub_change", "mevent = 'publication_changed'"),
             ("videp_pause", "mevent = 'video/pause'"), ("video_play", "mevent = 'video/play'"),
             ("shared", "substr(mevent, 1, 5) = 'share'"), ("setting_chg", "mevent = 'settings_changed'")]
    cols = ", ".join(f"count(DISTINCT eventid) FILTER (WHERE {t}) AS {n}" for n, t in tests)
    return with_ctes(I.SQL_APP_EVENTS, body=(
        'SELECT uid, CAST("timestamp" AS DATE) AS "date", '
        f"CAST(bool_or(mevent = 'install') AS INTEGER) AS install, {cols} "
        'FROM app_events GROUP BY uid, CAST("timestamp" AS DATE)'))


@register("daily_user_activity", _sql_daily_activity())
def q_daily_user_activity(spark, sf):
    from crowdscope.operators.aggregates import daily_user_activity
    return daily_user_activity(I.app_events(_t(spark, sf)))


_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@register("crosstab", "SELECT o_orderstatus AS o_orderstatus_o_orderpriority, " + ", ".join(
    f"count(*) FILTER (WHERE o_orderpriority = '{p}') AS \"{p}\"" for p in _PRIORITIES)
    + " FROM orders GROUP BY o_orderstatus")
def q_crosstab(spark, sf):
    from crowdscope.operators.aggregates import crosstab
    return crosstab(_t(spark, sf).orders, "o_orderstatus", "o_orderpriority", list(_PRIORITIES))


@register("crosstab_found", ORACLE["crosstab"])
def q_crosstab_found(spark, sf):
    """The same table with its columns found in the data."""
    from crowdscope.operators.aggregates import crosstab
    return crosstab(_t(spark, sf).orders, "o_orderstatus", "o_orderpriority")


@register("crosstab_counts", "SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY ALL")
def q_crosstab_counts(spark, sf):
    from crowdscope.operators.aggregates import crosstab_counts
    return crosstab_counts(_t(spark, sf).customer, "c_nationkey", "c_mktsegment")


@register("pivot_sum", "SELECT o_orderstatus, " + ", ".join(
    f"round(sum(CASE WHEN o_orderpriority = '{p}' THEN o_totalprice END), 2) AS \"{p}\"" for p in _PRIORITIES)
    + " FROM orders GROUP BY o_orderstatus")
def q_pivot_sum(spark, sf):
    from crowdscope.operators.aggregates import pivot_sum
    return pivot_sum(_t(spark, sf).orders, ["o_orderstatus"], "o_orderpriority", "o_totalprice",
                     values=list(_PRIORITIES), decimals=2)


@register("top_k_limit",
          "SELECT event_id, user_id, value FROM events ORDER BY value DESC, event_id LIMIT 10")
def q_top_k_limit(spark, sf):
    from crowdscope.operators.topk import top_k
    e = _t(spark, sf).events.select("event_id", "user_id", "value")
    return top_k(e, [F.desc("value"), F.asc("event_id")], 10)


# ------------------------------------------------------------------ columns --

@register("union_all_features", with_ctes(I.SQL_PROFILES, body=(
    "SELECT uid, 'asource' AS feature, asource AS value FROM profiles "
    "UNION ALL SELECT uid, 'localecity', localecity FROM profiles "
    "UNION ALL SELECT uid, 'scresolution', scresolution FROM profiles")))
def q_union_all_features(spark, sf):
    from crowdscope.operators.reshape import feature_union
    return feature_union(I.profiles(_t(spark, sf)), ["uid"], ["asource", "localecity", "scresolution"])


@register("device_key", f"SELECT p_partkey, dtype, {I.sql_device_key('dtype')} AS device_key "
          f"FROM (SELECT p_partkey, {I.SQL_DEVICE_TEXT} AS dtype FROM part)")
def q_device_key(spark, sf):
    from crowdscope.functions.columns import device_key
    d = I.device_text(_t(spark, sf).part)
    return d.select("p_partkey", "dtype", device_key("dtype").alias("device_key"))


@register("device_brand", f"SELECT p_partkey, {I.sql_device_brand('dtype')} AS device_brand "
          f"FROM (SELECT p_partkey, {I.SQL_DEVICE_TEXT} AS dtype FROM part)")
def q_device_brand(spark, sf):
    from crowdscope.functions.columns import device_brand
    d = I.device_text(_t(spark, sf).part)
    return d.select("p_partkey", device_brand("dtype").alias("device_brand"))


@register("device_price_enrich", with_ctes(*_BASE_CTES, body="SELECT uid, dtype2, price, price_range FROM pbase"))
def q_device_price_enrich(spark, sf):
    return _base(_t(spark, sf)).select("uid", "dtype2", "price", "price_range")


_S1, _S2 = sql_url_sections("url")


@register("url_sections", f"SELECT page_id, {_S1} AS col1, {_S2} AS col2 FROM pages")
def q_url_sections(spark, sf):
    from crowdscope.functions.columns import with_url_sections
    return with_url_sections(_t(spark, sf).pages.select("page_id", "url"), "url").select("page_id", "col1", "col2")


_PATH = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
_PSEG = f"string_split(regexp_replace({_PATH}, '^/', ''), '/')"


@register("url_sections_path", f"SELECT page_id, lower(trim(coalesce({_PSEG}[1], ''))) AS col1, "
          f"lower(trim(coalesce({_PSEG}[2], ''))) AS col2 FROM pages")
def q_url_sections_path(spark, sf):
    from crowdscope.functions.columns import with_url_sections
    p = _t(spark, sf).pages.select("page_id", "url")
    return with_url_sections(p, "url", fixed=True).select("page_id", "col1", "col2")


@register("install_weekday",
          "SELECT dayname(try_strptime(strftime(o_orderdate, '%d-%m-%Y'), '%d-%m-%Y')) AS install_day, "
          "count(*) AS orders FROM orders GROUP BY 1")
def q_install_weekday(spark, sf):
    from crowdscope.functions.columns import install_weekday
    o = _t(spark, sf).orders
    day = install_weekday(F.date_format("o_orderdate", "dd-MM-yyyy")).alias("install_day")
    return o.groupBy(day).agg(F.count(F.lit(1)).alias("orders"))


@register("list_item_at", with_ctes(I.SQL_PREFS, body="SELECT uid, " + ", ".join(
    f"string_split(channelids, ',')[{i + 1}] AS col{i + 1}" for i in range(30)) + " FROM prefs"))
def q_list_item_at(spark, sf):
    from crowdscope.operators.reshape import list_columns
    return list_columns(I.preferences(_t(spark, sf)), ["uid"], "channelids", 30)


@register("list_explode", with_ctes(I.SQL_PREFS, body=(
    "SELECT uid, CAST(i - 1 AS INTEGER) AS pos, l[i] AS value FROM ("
    "  SELECT uid, l, unnest(generate_series(1, len(l))) AS i FROM ("
    "    SELECT uid, string_split(channelids, ',') AS l FROM prefs WHERE channelids IS NOT NULL))")))
def q_list_explode(spark, sf):
    from crowdscope.operators.reshape import list_explode
    return list_explode(I.preferences(_t(spark, sf)), ["uid"], "channelids")


# ----------------------------------------------------------------- segments --

@register("segment_members", with_ctes(I.SQL_MEMBERS, body=(
    "SELECT segment_id, CAST(uid AS VARCHAR) AS uid FROM members")))
def q_segment_members(spark, sf):
    from crowdscope.sources.payloads import segment_members
    return segment_members(I.member_payloads(_t(spark, sf)))


@register("segment_left_join", with_ctes(I.SQL_MEMBERS, *_BASE_CTES, body=(
    "SELECT m.segment_id, pb.* FROM members m LEFT JOIN pbase pb ON m.uid = pb.uid")))
def q_segment_left_join(spark, sf):
    from crowdscope.plans import profile as P
    t = _t(spark, sf)
    return P.segment_left_join(I.members(t), _base(t))


@register("job_requests", with_ctes(I.SQL_MEMBERS, I.SQL_JOBS, SQL_SUBMITTED, body=(
    "SELECT job_id, job_status, segment_id, app, segment_compare FROM sjobs")))
def q_job_requests(spark, sf):
    return _jobs(_t(spark, sf)).drop("requested_at")


@register("profile_base", with_ctes(*_BASE_CTES, body="SELECT * FROM pbase"))
def q_profile_base(spark, sf):
    return _base(_t(spark, sf))


@register("feature_shares", with_ctes(I.SQL_MEMBERS, *_BASE_CTES, SQL_LONG, body="SELECT * FROM shares"))
def q_feature_shares(spark, sf):
    from crowdscope.plans import profile as P
    t = _t(spark, sf)
    return P.feature_shares(I.members(t), _base(t))


_SQL_TWICE = """pbase2 AS (SELECT * FROM pbase
  UNION ALL SELECT * REPLACE (upper(languages) AS languages) FROM pbase)"""


@register("feature_shares_repeated_uid", with_ctes(I.SQL_MEMBERS, *_BASE_CTES, _SQL_TWICE, _sql_long("pbase2"),
                                                   body="SELECT * FROM shares"))
def q_feature_shares_repeated_uid(spark, sf):
    """A base in which every uid has two rows (a second language): shares
    still count distinct users."""
    from crowdscope.plans import profile as P
    t = _t(spark, sf)
    base = _base(t)
    return P.feature_shares(I.members(t), base.unionByName(base.withColumn("languages", F.upper("languages"))))


@register("top_features", with_ctes(I.SQL_MEMBERS, *_BASE_CTES, SQL_LONG, body="SELECT * FROM top WHERE rank <= 10"))
def q_top_features(spark, sf):
    from crowdscope.plans import profile as P
    t = _t(spark, sf)
    return P.top_features(*P.counted(I.members(t), _base(t)))


@register("segment_compare", with_ctes(I.SQL_MEMBERS, *_BASE_CTES, SQL_LONG, I.SQL_JOBS, SQL_SUBMITTED, body=(
    "SELECT j.job_id, j.segment_id, j.segment_compare, t.feature, t.feature_values, t.perc_users, "
    "coalesce(o.perc_users, 0.0) AS perc_users_compare "
    "FROM sjobs j JOIN top t ON t.segment_id = j.segment_id AND t.rank <= 10 "
    "LEFT JOIN shares o ON o.segment_id = j.segment_compare AND o.feature = t.feature "
    "AND o.feature_values = t.feature_values")))
def q_segment_compare(spark, sf):
    from crowdscope.plans import profile as P
    t = _t(spark, sf)
    return P.segment_compare(_jobs(t), *P.counted(I.members(t), _base(t)))


@register("profile_json")
def q_profile_json(spark, sf):
    from crowdscope.plans import profile as P
    t = _t(spark, sf)
    return P.profile_json(*P.counted(I.members(t), _base(t)))


@register("profile_json_entries", with_ctes(I.SQL_MEMBERS, *_BASE_CTES, SQL_LONG, body=(
    "SELECT segment_id, feature, feature_values, perc_users AS share FROM top WHERE rank <= 10")))
def q_profile_json_entries(spark, sf):
    """The per-feature JSON objects parsed back into rows (K7 checked)."""
    from crowdscope.plans import profile as P
    t = _t(spark, sf)
    js = P.profile_json(*P.counted(I.members(t), _base(t)))
    return js.select("segment_id", "feature", F.explode(F.from_json("data", "map<string, double>"))
                     .alias("feature_values", "share"))


@register("profile_report")
def q_profile_report(spark, sf):
    from crowdscope.plans import profile as P
    t = _t(spark, sf)
    return P.jobs_profiles(_jobs(t), I.members(t), _base(t))


def _sql_report_entries() -> str:
    from crowdscope.plans import profile as P
    feats = ", ".join(f"({i}, '{fid}', '{name}')" for i, (fid, name) in enumerate(P.FEATURES))
    return with_ctes(
        I.SQL_MEMBERS, *_BASE_CTES, SQL_LONG, I.SQL_JOBS, SQL_SUBMITTED,
        f"feat AS (SELECT * FROM (VALUES {feats}) f(pos, feature, name))",
        "cmp AS (SELECT j.job_id, t.feature, t.feature_values, coalesce(o.perc_users, 0.0) AS share "
        "FROM sjobs j JOIN top t ON t.segment_id = j.segment_id AND t.rank <= 10 "
        "LEFT JOIN shares o ON o.segment_id = j.segment_compare AND o.feature = t.feature "
        "AND o.feature_values = t.feature_values)",
        body=("SELECT j.job_id, 'result' AS side, f.pos, f.feature, f.name, 'bar' AS display, "
              "t.feature_values, t.perc_users AS share FROM sjobs j CROSS JOIN feat f "
              "LEFT JOIN top t ON t.segment_id = j.segment_id AND t.feature = f.feature AND t.rank <= 10 "
              "UNION ALL SELECT j.job_id, 'result_compare', f.pos, f.feature, f.name, 'bar', c.feature_values, "
              "c.share FROM sjobs j CROSS JOIN feat f LEFT JOIN cmp c ON c.job_id = j.job_id "
              "AND c.feature = f.feature"))


@register("profile_report_entries", _sql_report_entries())
def q_profile_report_entries(spark, sf):
    from crowdscope.plans import profile as P
    t = _t(spark, sf)
    return P.report_entries(P.jobs_profiles(_jobs(t), I.members(t), _base(t)))


# ---------------------------------------------------------------- cohorts ----

_SQL_INSTALLS = "inst AS (SELECT DISTINCT uid, d FROM ev WHERE mevent = 'install')"
_SQL_COHORTS = (f"coh AS (SELECT uid, d AS idate FROM inst WHERE d >= DATE '{I.RET_START}' "
                f"AND d <= DATE '{I.RET_AS_OF}')")


@register("cohort_users", with_ctes(I.SQL_EV, I.SQL_MEMBERS, _SQL_INSTALLS, _SQL_COHORTS, body=(
    "SELECT DISTINCT m.segment_id, c.uid, c.idate FROM members m JOIN coh c ON m.uid = c.uid")))
def q_cohort_users(spark, sf):
    t = _t(spark, sf)
    return R.cohort_users(I.retention_events(t), I.members(t), I.RET_START, I.RET_AS_OF)


def _sql_reinstall() -> str:
    lost = ", ".join(
        f"(coalesce(maxtime < idate + {n}, false) OR coalesce(next_install < idate + {n}, false)) AS lost_{name}"
        for name, n in _RET_WINDOWS)
    return with_ctes(I.SQL_EV, _SQL_INSTALLS, _SQL_COHORTS,
                     "nx AS (SELECT c.uid, c.idate, (SELECT min(i.d) FROM inst i WHERE i.uid = c.uid "
                     "AND i.d > c.idate) AS next_install FROM coh c)",
                     "la AS (SELECT uid, max(d) AS maxtime FROM ev GROUP BY uid)",
                     body=f"SELECT nx.uid, idate, next_install, maxtime, {lost} FROM nx LEFT JOIN la ON nx.uid = la.uid")


@register("reinstall_within", _sql_reinstall())
def q_reinstall_within(spark, sf):
    return R.reinstall_within(I.retention_events(_t(spark, sf)), I.RET_START, I.RET_AS_OF)


# ----------------------------------------------------------------- tagging ---

def _sql_category_shares(taxonomy, reads: str) -> str:
    s1, s2 = sql_url_sections("aurl")
    cats = []
    for c in taxonomy:
        terms = []
        if c.section1:
            terms.append("col1 IN (" + ", ".join(f"'{x}'" for x in c.section1) + ")")
        if c.section2:
            terms.append("col2 IN (" + ", ".join(f"'{x}'" for x in c.section2) + ")")
        cats.append(f"count(*) FILTER (WHERE {' OR '.join(terms)}) / count(*) AS {c.name}")
    return with_ctes(reads,
                     f"sec AS (SELECT uid, {s1} AS col1, {s2} AS col2 FROM reads WHERE mevent = 'read')",
                     f"cs AS (SELECT uid, {', '.join(cats)}, count(*) AS tot_readevent FROM sec GROUP BY uid)",
                     body="SELECT * FROM cs")


def _sql_unpivot(taxonomy) -> str:
    return " UNION ALL ".join(
        f"SELECT uid, tot_readevent, '{c.name}' AS pref_catg, {c.name} AS value FROM cs" for c in taxonomy)


_SQL_CS = _sql_category_shares(I.SHOP_TAXONOMY, I.SQL_READS)
_SQL_NEWS_CS = _sql_category_shares(NEWS_TAXONOMY, I.SQL_NEWS_READS)
_SQL_RULES = " OR ".join(f"value > {share} AND tot_readevent {'>=' if inclusive else '>'} {n}"
                         for share, n, inclusive in TAG_RULES)
_SQL_TAGGABLE = ", ".join(f"'{x}'" for x in TAGGABLE)
_SQL_UNPIVOT = _sql_unpivot(I.SHOP_TAXONOMY)


def _sql_tags(shares: str, unpivot: str) -> str:
    head = (f"SELECT CAST(month(DATE '{I.TAG_AS_OF}') AS INTEGER) AS month, "
            f"CAST(year(DATE '{I.TAG_AS_OF}') AS INTEGER) AS year, uid, pref_catg, value, tot_readevent FROM (")
    return shares.replace("SELECT * FROM cs", head + unpivot.replace("FROM cs", "FROM cs WHERE uid IS NOT NULL")
                          + f") WHERE ({_SQL_RULES}) AND pref_catg IN ({_SQL_TAGGABLE})")


@register("category_shares", _SQL_CS)
def q_category_shares(spark, sf):
    from crowdscope.plans import tagging as G
    return G.category_shares(I.reads(_t(spark, sf)), I.SHOP_TAXONOMY)


@register("unpivot_shares", _SQL_CS.replace("SELECT * FROM cs", _SQL_UNPIVOT))
def q_unpivot_shares(spark, sf):
    from crowdscope.plans import tagging as G
    return G.unpivot_shares(G.category_shares(I.reads(_t(spark, sf)), I.SHOP_TAXONOMY), I.SHOP_TAXONOMY)


@register("category_shares_news", _SQL_NEWS_CS)
def q_category_shares_news(spark, sf):
    from crowdscope.plans import tagging as G
    return G.category_shares(I.news_reads(_t(spark, sf)))


@register("interest_tags_news", _sql_tags(_SQL_NEWS_CS, _sql_unpivot(NEWS_TAXONOMY)))
def q_interest_tags_news(spark, sf):
    from crowdscope.plans import tagging as G
    return G.interest_tags(I.news_reads(_t(spark, sf)), I.TAG_AS_OF)


@register("interest_tags", _sql_tags(_SQL_CS, _SQL_UNPIVOT))
def q_interest_tags(spark, sf):
    from crowdscope.plans import tagging as G
    return G.interest_tags(I.reads(_t(spark, sf)), I.TAG_AS_OF, I.SHOP_TAXONOMY)


def _sql_tags_window() -> str:
    import datetime as dt
    end = dt.date.fromisoformat(I.TAG_AS_OF)
    start = (end - dt.timedelta(days=31)).isoformat()
    windowed = I.SQL_READS.replace(
        "JOIN part p ON l.l_partkey = p.p_partkey)",
        f"JOIN part p ON l.l_partkey = p.p_partkey WHERE l.l_shipdate >= TIMESTAMP '{start}' + INTERVAL 1 MILLISECOND "
        f"AND l.l_shipdate < TIMESTAMP '{I.TAG_AS_OF}' + INTERVAL 1 MILLISECOND)")
    return ORACLE["interest_tags"].replace(I.SQL_READS, windowed)


@register("interest_tags_window", _sql_tags_window())
def q_interest_tags_window(spark, sf):
    from crowdscope.plans import tagging as G
    return G.daily_tags(I.reads(_t(spark, sf)), I.TAG_AS_OF, taxonomy=I.SHOP_TAXONOMY)


_UUID = "^[0-9a-f]{8}-[0-9a-f]{4}-7[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"


@register("tag_row_ids", ORACLE["interest_tags"].replace(
    "SELECT CAST(month(", "SELECT true AS has_row_id, CAST(month(", 1))
def q_tag_row_ids(spark, sf):
    """Tags with a generated row id (D1): the id itself is replaced by a check
    that every row carries a well-formed UUID of its creation time."""
    from crowdscope.plans import tagging as G
    tags = G.with_row_ids(G.interest_tags(I.reads(_t(spark, sf)), I.TAG_AS_OF, I.SHOP_TAXONOMY))
    timed = G.row_id_millis(F.col("createdtime")) == F.unix_millis("created_at")
    return tags.select((F.col("createdtime").rlike(_UUID) & timed).alias("has_row_id"), "month", "year", "uid", "pref_catg",
                       "value", "tot_readevent")


# ------------------------------------------------------------ sinks, stream --

@register("upsert_latest_by_key", (
    "SELECT user_id, event_id, event_type, value, written_at FROM ("
    "  SELECT user_id, event_id, event_type, value, ts AS written_at, row_number() OVER ("
    "    PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"))
def q_upsert_latest_by_key(spark, sf):
    from crowdscope.sinks.writers import upsert
    e = _t(spark, sf).events.select("user_id", "event_id", "event_type", "value", F.col("ts").alias("written_at"))
    cut = F.lit(I.EVENTS_TS_END).cast("timestamp_ntz")
    return upsert(e.filter(F.col("written_at") < cut), e.filter(F.col("written_at") >= cut),
                  ["user_id"], "written_at", [F.desc("event_id")])


@register("upsert_table_roundtrip", ORACLE["upsert_latest_by_key"])
def q_upsert_table_roundtrip(spark, sf):
    """The keyed table is created from the events before the cut, then the
    later events are upserted; its current version holds the latest event per
    user (K4), the version before it still reads as it was."""
    from crowdscope.session import scratch_path
    from crowdscope.sinks.keyed import KeyedTable
    e = _t(spark, sf).events.select("user_id", "event_id", "event_type", "value", F.col("ts").alias("written_at"))
    path = scratch_path(spark, "keyed-events")
    cut = F.lit(I.EVENTS_TS_END).cast("timestamp_ntz")
    table = KeyedTable(spark, path, ["user_id"], tiebreak=[F.desc("event_id")], buckets=16)
    table.upsert(e.filter(F.col("written_at") < cut))
    table.upsert(e.filter(F.col("written_at") >= cut))
    return table.read()


@register("sink_append_roundtrip", (
    'SELECT CAST(ts AS DATE) AS "date", count(*) AS n, count(DISTINCT user_id) AS users '
    "FROM events GROUP BY CAST(ts AS DATE)"))
def q_sink_append_roundtrip(spark, sf):
    from crowdscope.session import scratch_path
    from crowdscope.sinks.writers import write_table
    ev = I.app_events(_t(spark, sf)).withColumn("date", F.to_date("timestamp"))
    path = scratch_path(spark, "events-append")
    cut = F.lit(I.EVENTS_TS_END).cast("timestamp_ntz")
    cols = ["eventid", "uid", "timestamp", "mevent", "date"]
    write_table(ev.filter(F.col("timestamp") < cut), path, "errorifexists", ["date"], columns=cols)
    write_table(ev.filter(F.col("timestamp") >= cut), path, "append", ["date"], columns=cols)
    back = spark.read.parquet(path)
    return (back.groupBy(F.col("date").cast("date").alias("date"))
            .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("uid").alias("users")))


@register("delimited_text_read",
          "SELECT p_partkey, p_brand, p_size FROM part WHERE p_size BETWEEN 3 AND 45 AND p_size <> 10")
def q_delimited_text_read(spark, sf):
    """Part rows written as tab-separated lines, some malformed on purpose:
    an extra field (size > 45), a missing field (size < 3), and a trailing
    empty field (size 10, which splits to two fields and is dropped)."""
    from pyspark.sql import types as T
    from crowdscope.session import scratch_path
    from crowdscope.sources.text import read_delimited
    p = _t(spark, sf).part
    key, brand, size = (F.col("p_partkey").cast("string"), F.col("p_brand"), F.col("p_size").cast("string"))
    line = (F.when(F.col("p_size") > 45, F.concat_ws("\t", key, brand, size, F.lit("extra")))
            .when(F.col("p_size") < 3, F.concat_ws("\t", key, brand))
            .when(F.col("p_size") == 10, F.concat_ws("\t", key, brand, F.lit("")))
            .otherwise(F.concat_ws("\t", key, brand, size)))
    path = scratch_path(spark, "part-tsv")
    p.select(line.alias("value")).write.text(path)
    schema = T.StructType([T.StructField("p_partkey", T.LongType()), T.StructField("p_brand", T.StringType()),
                           T.StructField("p_size", T.IntegerType())])
    return read_delimited(spark, path, schema)


@register("daily_activity_table", _sql_daily_activity())
def q_daily_activity_table(spark, sf):
    """Daily activity written as a table keyed by (uid, date): partitioned by
    date with uid hashed into buckets (K3), then read back."""
    from crowdscope.operators.aggregates import daily_user_activity
    from crowdscope.session import scratch_path
    from crowdscope.sinks.writers import write_table
    path = scratch_path(spark, "daily-activity")
    write_table(daily_user_activity(I.app_events(_t(spark, sf))), path, "errorifexists", ["date"],
                bucket_keys=["uid"], buckets=4)
    back = spark.read.parquet(path)
    return back.select("uid", F.col("date").cast("date").alias("date"), "install", "read", "notf_del", "notf_open",
                       "pub_change", "videp_pause", "video_play", "shared", "setting_chg")


@register("csv_source_options", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def q_csv_source_options(spark, sf):
    """A source read by format name and options (S3): the nation table as
    ';'-separated text with a header, read back with a declared schema."""
    from crowdscope.session import scratch_path
    from crowdscope.sources.tables import read_table
    path = scratch_path(spark, "nation-csv")
    _t(spark, sf).nation.write.options(header="true", sep=";").csv(path)
    return read_table(spark, path, "", "csv", {"header": "true", "sep": ";"},
                      schema="n_nationkey INT, n_name STRING, n_regionkey INT")


def _run_job_stream(spark, sf):
    from crowdscope.session import scratch_path
    from crowdscope.streaming.jobs import start_job_stream
    t = _t(spark, sf)
    jobs_dir, out_dir, ckpt = (scratch_path(spark, n) for n in ("jobs-in", "jobs-out", "jobs-ckpt"))
    payloads = I.job_payloads(t)
    payloads.coalesce(1).write.text(f"{jobs_dir}/delivery=1")
    payloads.coalesce(1).write.text(f"{jobs_dir}/delivery=2")      # the same requests delivered again
    # fresh readers per micro-batch (it sees current data), shared by both
    # inputs of that batch: members() is called first, then base()
    batch = {}

    def members_fn():
        batch["t"] = Tables(spark, sf, fresh=True)
        return I.members(batch["t"])

    # one delivery per micro-batch: the second batch re-delivers every request
    q = start_job_stream(spark, jobs_dir, out_dir, ckpt, members_fn, lambda: _base(batch["t"]), I.APP,
                         available_now=True, files_per_batch=1)
    q.awaitTermination()
    return out_dir


@register("stream_job_profiles", ORACLE["profile_report_entries"])
def q_stream_job_profiles(spark, sf):
    """The stream's reports (latest per job, after a re-delivery of every
    request) parsed back into rows: they must equal the batch report."""
    from crowdscope.plans import profile as P
    from crowdscope.streaming.jobs import read_reports
    return P.report_entries(read_reports(spark, _run_job_stream(spark, sf)))


def _sql_status_log() -> str:
    from crowdscope.sinks.writers import PROGRESS_POINTS
    steps = ", ".join(f"('EXECUTING', {p})" for p in (0, *PROGRESS_POINTS)) + ", ('SUCCESS', 100)"
    return with_ctes(I.SQL_MEMBERS, I.SQL_JOBS, SQL_SUBMITTED,
                     f"steps AS (SELECT * FROM (VALUES {steps}) s(status, completion_pct))",
                     body="SELECT j.job_id, s.status, s.completion_pct, true AS in_order FROM sjobs j CROSS JOIN steps s")


@register("job_status_log", _sql_status_log())
def q_job_status_log(spark, sf):
    """Status events that the job stream wrote for every submitted job, each
    when its step was done: ``in_order`` says that its time is not before that
    of the step before (the JSON payloads are checked in unit tests)."""
    from pyspark.sql import Window
    from crowdscope.streaming.jobs import read_status
    job = Window.partitionBy("job_id").orderBy("completion_pct")
    return read_status(spark, _run_job_stream(spark, sf)).select(
        "job_id", "status", "completion_pct",
        (F.col("event_ms") >= F.coalesce(F.lag("event_ms").over(job), F.lit(0))).alias("in_order"))


SQL_JOB_RUNS = """
WITH RECURSIVE ev AS (
  SELECT user_id AS job_id, CASE WHEN event_type = 'view' THEN 'request' ELSE 'done' END AS kind, ts AS t
  FROM events WHERE event_type IN ('view', 'purchase') AND user_id IS NOT NULL AND ts IS NOT NULL),
runs AS (
  SELECT job_id, min(t) AS started FROM ev WHERE kind = 'request' GROUP BY job_id
  UNION ALL
  SELECT r.job_id, min(e.t) FROM runs r JOIN ev e ON e.job_id = r.job_id AND e.kind = 'request'
    AND e.t >= r.started + INTERVAL 72000 SECOND GROUP BY r.job_id, r.started),
f AS (
  SELECT r.job_id, r.started, min(e.t) FILTER (WHERE e.kind = 'done') AS finished,
         count(*) FILTER (WHERE e.kind = 'request') - 1 AS again
  FROM runs r JOIN ev e ON e.job_id = r.job_id AND e.t >= r.started AND e.t < r.started + INTERVAL 72000 SECOND
  GROUP BY r.job_id, r.started)
SELECT job_id, 'EXECUTING' AS status, started AS started_at, NULL::TIMESTAMP AS finished_at, 0 AS redelivered FROM runs
UNION ALL
SELECT job_id, CASE WHEN finished IS NULL THEN 'EXPIRED' ELSE 'SUCCESS' END, started,
       coalesce(finished, started + INTERVAL 72000 SECOND), again::INTEGER
FROM f WHERE started + INTERVAL 72000 SECOND < (SELECT max(t) FROM ev)"""


@register("job_deadline_states", SQL_JOB_RUNS)
def q_job_deadline_states(spark, sf):
    """Runs of jobs with their 72,000 s deadline (T1): every user's views ask
    for a job, purchases end it. The events arrive in two deliveries by time;
    the first is delivered once more at the end, when all of it is late."""
    from crowdscope.session import scratch_path
    from crowdscope.streaming.deadlines import job_runs
    e = _t(spark, sf).events.filter(F.col("event_type").isin("view", "purchase")).select(
        F.col("user_id").alias("job_id"), F.when(F.col("event_type") == "view", "request").otherwise("done").alias("kind"),
        F.col("ts").cast("timestamp").alias("at"))
    into, out, ckpt = (scratch_path(spark, n) for n in ("runs-in", "runs-out", "runs-ckpt"))
    early = F.col("at") < F.lit(I.EVENTS_TS_END).cast("timestamp")
    for i, part in enumerate([e.filter(early), e.filter(~early), e.filter(early)]):
        part.write.parquet(f"{into}/delivery={i}")
        stream = spark.readStream.schema(e.schema).parquet(f"{into}/delivery=*")
        query = (job_runs(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
                 .trigger(availableNow=True).start())
        query.awaitTermination()
    return spark.read.parquet(out).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("started_at", "finished_at")})


@register("append_repeated_run", ORACLE["sink_append_roundtrip"])
def q_append_repeated_run(spark, sf):
    """Two runs are appended, each sent twice; a repeated run id adds nothing (K1)."""
    from crowdscope.session import scratch_path
    from crowdscope.sinks.keyed import append_once, read_appended
    ev = I.app_events(_t(spark, sf)).withColumn("date", F.to_date("timestamp")).select("eventid", "uid", "timestamp", "mevent", "date")
    path, cut = scratch_path(spark, "events-runs"), F.lit(I.EVENTS_TS_END).cast("timestamp_ntz")
    runs = {"first": ev.filter(F.col("timestamp") < cut), "second": ev.filter(F.col("timestamp") >= cut)}
    for run in ("first", "second", "second", "first"):
        append_once(runs[run], path, run, ["date"])
    return (read_appended(spark, path).groupBy(F.col("date").cast("date").alias("date"))
            .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("uid").alias("users")))


@register("retention_incremental", ORACLE["retention_daily_window"])
def q_retention_incremental(spark, sf):
    """Retention from a kept state (C1, A7): the state of three days before is
    landed, then each day's events are merged into it without reading older ones."""
    import datetime as dt
    from crowdscope.plans.incremental import merge_state, retention_of_state, scanned_days
    from crowdscope.session import scratch_path
    t = Tables(spark, sf)
    members = t.customer.select(F.lower("c_mktsegment").alias("segment_id"), F.col("c_custkey").alias("uid"))
    end, events, path = dt.date.fromisoformat(I.EVENTS_AS_OF), I.app_signups(t), scratch_path(spark, "retention-state")
    days = [end - dt.timedelta(days=i) for i in (3, 2, 1, 0)]
    scanned_days(events, days[0] - dt.timedelta(days=94), days[0]).write.parquet(f"{path}/{days[0]}")
    for before, day in zip(days, days[1:]):
        state = spark.read.parquet(f"{path}/{before}")
        merge_state(state, scanned_days(events, before, day), day).write.parquet(f"{path}/{day}")
    return retention_of_state(spark.read.parquet(f"{path}/{end}"), members, end, with_timestamp=False)


# ------------------------------------------- hot keys, bitmaps, observed writes

@register("segment_left_join_hot", with_ctes(I.SQL_HOT_MEMBERS, *_BASE_CTES, body=(
    "SELECT m.segment_id, pb.* FROM members m LEFT JOIN pbase pb ON m.uid = pb.uid")))
def q_segment_left_join_hot(spark, sf):
    """One id has most member rows, others have no profile (J3). A task takes
    about 200 rows of one id here, so that the id is dealt at any test size."""
    from crowdscope.plans import profile as P
    t = _t(spark, sf)
    return P.segment_left_join_hot(I.hot_members(t), _base(t), hot_rows=200)


@register("feature_shares_unmatched", with_ctes(I.SQL_HOT_MEMBERS, *_BASE_CTES, SQL_LONG, body="SELECT * FROM shares"))
def q_feature_shares_unmatched(spark, sf):
    """Shares of segments with ids that have no profile."""
    from crowdscope.plans import profile as P
    t = _t(spark, sf)
    return P.feature_shares(I.hot_members(t), _base(t))


def _sql_active_within() -> str:
    flags = ", ".join(f"EXISTS (SELECT 1 FROM ev e WHERE e.uid = c.uid AND e.d > c.idate AND e.d < c.idate + {n}) AS active_{name}"
                      for name, n in _RET_WINDOWS)
    return with_ctes(I.SQL_EV, _SQL_INSTALLS, _SQL_COHORTS, body=f"SELECT c.uid, c.idate, {flags} FROM coh c")


@register("active_within", _sql_active_within())
def q_active_within(spark, sf):
    return R.active_within(I.retention_events(_t(spark, sf)), I.RET_START, I.RET_AS_OF)


@register("feature_shares_bitmap", ORACLE["feature_shares_unmatched"])
def q_feature_shares_bitmap(spark, sf):
    """Shares from daily bitmaps (A5, A10, A16): a profile is seen on the day
    of the month of its install and the day after. The users of the first
    half are numbered first, the others appended; the days' states are landed
    and merged without reading a profile again."""
    from crowdscope.operators.bitmaps import extend_dictionary, number_users
    from crowdscope.plans import profile as P
    from crowdscope.session import scratch_path
    t = _t(spark, sf)
    first = F.coalesce(F.dayofmonth(F.try_to_date("idate", "dd-MM-yyyy")), F.lit(1))
    base = _base(t).withColumn("day", F.explode(F.array(first, first + 1)))
    users, states = scratch_path(spark, "users"), scratch_path(spark, "feature-bitmaps")
    number_users(base.filter(F.col("day") <= 15)).write.parquet(users)
    more = extend_dictionary(spark.read.parquet(users), base)
    more.write.parquet(f"{users}-more")
    dictionary = spark.read.parquet(users, f"{users}-more")
    members = I.hot_members(t)
    P.feature_bitmaps(members, base, dictionary).write.partitionBy("day").parquet(states)
    return P.with_shares(P.bitmap_feature_counts(spark.read.parquet(states), members), P.segment_sizes(members))


@register("quality_on_write", ORACLE["column_quality_all"])
def q_quality_on_write(spark, sf):
    """The quality of a table, measured while it is written."""
    from crowdscope.session import scratch_path
    from crowdscope.sinks.observed import write_with_quality
    return write_with_quality(I.event_records(_t(spark, sf)), scratch_path(spark, "records"), list(I.QUALITY_COLUMNS))
