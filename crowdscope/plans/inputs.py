"""Engine inputs derived from the driver's tables (FIXTURES.md section 2).

Each builder has a SQL twin (a DuckDB CTE) kept next to it, so the oracle
queries start from exactly the same inputs. Everything here is derived from
whole tables with joins and aggregations, so its size grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdscope.functions import columns as C
from crowdscope.functions.taxonomy import NEWS_TAXONOMY, Category
from crowdscope.sources.tables import read_table

RET_START = "1995-01-01"
RET_AS_OF = "2001-08-01"             # the last order date
PRICE_LOW_BELOW = 950.0
APP = "news_app"
HOT_UID = 7                          # the id that one segment repeats
TAG_AS_OF = "2001-08-01"
EVENTS_TS_START = "2024-01-10 00:00:00"
EVENTS_TS_END = "2024-01-20 00:00:00"

# --- Fixed values for the test taxonomy over shop URLs (FIXTURES.md 2.2) ----
SHOP_NOUNS = ("anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget")
SHOP_TAXONOMY: tuple[Category, ...] = (
    Category("business", ("economy", "promo"), tuple(f"hot-{n}" for n in SHOP_NOUNS)),
    Category("sports", ("small", "medium"), tuple(f"red-{n}" for n in SHOP_NOUNS)),
    Category("health", ("large",), tuple(f"old-{n}" for n in SHOP_NOUNS)),
    Category("politics", ("standard",), ()),
)
# ---------------------------------------------------------------------------



# Readers shared per session and directory: the driver's tables are
# read-only, so their file listing and schema are read once per session.
_SHARED: dict[tuple[int, str, bool], dict[str, DataFrame]] = {}


def _session_key(spark: SparkSession) -> str:
    """Identity of a live session: application id plus the session's UUID
    (a new context or session never reuses cached readers of an old one)."""
    try:
        uuid = spark._jsparkSession.sessionUUID()
    except Exception:  # noqa: BLE001 - older JVM API
        uuid = str(id(spark._jsparkSession))
    return f"{spark.sparkContext.applicationId}/{uuid}"


class Tables:
    """Lazy reader of the driver's parquet tables under one directory.

    ``fresh=True`` gives private readers that list the files again (for
    tables that change between uses, such as inputs of a running stream)."""

    def __init__(self, spark: SparkSession, base: str, fresh: bool = False):
        self.spark, self.base = spark, base.rstrip("/")
        key = (_session_key(spark), self.base)
        self._frames: dict[str, DataFrame] = {} if fresh else _SHARED.setdefault(key, {})

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        # one reader per table: the file listing and footer read happen once
        if name not in self._frames:
            df = read_table(self.spark, self.base, name, "parquet")
            self._frames[name] = df
        return self._frames[name]


def derived(fn):
    """Memoize a derived input on its :class:`Tables`: DataFrames are
    immutable, so queries of one session reuse the same lazy plan instead of
    rebuilding (and re-analysing) it. Fresh ``Tables`` get fresh inputs."""
    import functools

    @functools.wraps(fn)
    def wrapper(t: Tables, *args):
        key = ("derived", fn.__name__) + args
        if key not in t._frames:
            t._frames[key] = fn(t, *args)
        return t._frames[key]
    return wrapper


# ---------------------------------------------------------------- retention --
@derived
def retention_events(t: Tables) -> DataFrame:
    """Orders as app events: urgent orders are installs, the rest reads."""
    o = t.orders
    return (o.select(F.col("o_custkey").alias("uid"), F.to_date("o_orderdate").alias("d"),
                    F.when(F.col("o_orderpriority") == "1-URGENT", "install")
                    .otherwise("read").alias("mevent")))


SQL_EV = f"""ev AS (
  SELECT o_custkey AS uid, CAST(o_orderdate AS DATE) AS d,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'install' ELSE 'read' END AS mevent
  FROM orders)"""


# ------------------------------------------------------------------ members --
@derived
def members(t: Tables) -> DataFrame:
    """``(segment_id, uid)``: one segment per market segment, ``all`` with
    every customer, and ``urgent_buyers`` listing the buyer of every urgent
    order (so ids repeat, as membership exports do)."""
    c, o = t.customer, t.orders
    by_market = c.select(F.lower("c_mktsegment").alias("segment_id"), F.col("c_custkey").alias("uid"))
    everyone = c.select(F.lit("all").alias("segment_id"), F.col("c_custkey").alias("uid"))
    urgent = (o.filter(F.col("o_orderpriority") == "1-URGENT")
              .select(F.lit("urgent_buyers").alias("segment_id"), F.col("o_custkey").alias("uid")))
    return by_market.unionByName(everyone).unionByName(urgent)


SQL_MEMBERS = """members AS (
  SELECT lower(c_mktsegment) AS segment_id, c_custkey AS uid FROM customer
  UNION ALL SELECT 'all', c_custkey FROM customer
  UNION ALL SELECT 'urgent_buyers', o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')"""


@derived
def hot_members(t: Tables) -> DataFrame:
    """Members of which one id has most rows (one for every order) and some
    ids have no profile (``lapsed``: customers in debt under an old id)."""
    c = t.customer
    by_market = c.select(F.lower("c_mktsegment").alias("segment_id"), F.col("c_custkey").alias("uid"))
    lapsed = c.filter(F.col("c_acctbal") < 0).select(F.lit("lapsed").alias("segment_id"), (-F.col("c_custkey") - 1).alias("uid"))
    hot = t.orders.select(F.lit("kiosk").alias("segment_id"), F.lit(HOT_UID).cast("long").alias("uid"))
    return by_market.unionByName(lapsed).unionByName(hot)


SQL_HOT_MEMBERS = f"""members AS (
  SELECT lower(c_mktsegment) AS segment_id, c_custkey AS uid FROM customer
  UNION ALL SELECT 'lapsed', -c_custkey - 1 FROM customer WHERE c_acctbal < 0
  UNION ALL SELECT 'kiosk', {HOT_UID} FROM orders)"""


@derived
def member_payloads(t: Tables, page_size: int = 1000) -> DataFrame:
    """Members as JSON list pages ``{"users": [...]}`` of at most
    ``page_size`` rows, like a paged membership API. A page is a run of
    consecutive rows of one scan partition, so no page grows with the data,
    even when one id is listed millions of times."""
    m = members(t)
    page = F.floor(F.monotonically_increasing_id() / page_size)
    return (m.groupBy("segment_id", page.alias("page"))
            .agg(F.to_json(F.struct(F.collect_list(F.col("uid").cast("string")).alias("users")))
                 .alias("payload")))


# ----------------------------------------------------------------- profiles --
def device_text(p: DataFrame) -> DataFrame:
    """Raw ``brand/model`` text per part; large parts repeat the brand inside
    the model so both device-key rules are exercised."""
    return p.select("p_partkey", "p_brand", "p_retailprice", F.when(
        F.col("p_size") > 25, F.concat_ws("/", "p_brand", F.concat_ws(" ", "p_brand", "p_name")))
        .otherwise(F.concat_ws("/", "p_brand", "p_name")).alias("dtype"))


SQL_DEVICE_TEXT = ("CASE WHEN p_size > 25 THEN p_brand || '/' || p_brand || ' ' || p_name "
                   "ELSE p_brand || '/' || p_name END")


@derived
def profiles(t: Tables) -> DataFrame:
    c, n, o = t.customer, t.nation, t.orders
    first_order = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderdate").alias("first_ts"))
    dev = device_text(t.part).select(F.col("p_partkey").alias("c_custkey"), "dtype")
    bal = F.col("c_acctbal")
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .join(dev, "c_custkey", "left")
            .join(first_order, "c_custkey", "left")
            .select(F.col("c_custkey").alias("uid"),
                    F.col("c_mktsegment").alias("asource"),
                    F.concat(F.lit("v"), F.floor(bal / 1000).cast("bigint").cast("string")).alias("aversion"),
                    F.col("n_name").alias("localecity"),
                    F.concat(F.lit("os"), F.col("n_regionkey").cast("string")).alias("osversion"),
                    F.when(bal >= 0, F.floor(bal / 2500).cast("bigint").cast("string")).alias("scresolution"),
                    "dtype",
                    F.date_format("first_ts", "dd-MM-yyyy").alias("idate")))


SQL_PROFILES = f"""profiles AS (
  SELECT c.c_custkey AS uid, c.c_mktsegment AS asource,
         'v' || CAST(CAST(floor(c.c_acctbal / 1000) AS BIGINT) AS VARCHAR) AS aversion,
         n.n_name AS localecity, 'os' || CAST(n.n_regionkey AS VARCHAR) AS osversion,
         CASE WHEN c.c_acctbal >= 0 THEN CAST(CAST(floor(c.c_acctbal / 2500) AS BIGINT) AS VARCHAR) END AS scresolution,
         dv.dtype, strftime(fo.first_ts, '%d-%m-%Y') AS idate
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN (SELECT p_partkey, {SQL_DEVICE_TEXT} AS dtype FROM part) dv ON dv.p_partkey = c.c_custkey
  LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_ts FROM orders GROUP BY o_custkey) fo
         ON fo.o_custkey = c.c_custkey)"""


@derived
def preferences(t: Tables) -> DataFrame:
    """Order priorities as a sorted comma list; customers without an order
    have no preferences row."""
    o, c = t.orders, t.customer
    ordered = (o.groupBy(F.col("o_custkey").alias("uid"))
              .agg(F.array_join(F.array_sort(F.collect_set("o_orderpriority")), ",").alias("channelids")))
    return ordered.join(c.select(F.col("c_custkey").alias("uid"),
                                F.lower("c_mktsegment").alias("languages")), "uid")


SQL_PREFS = f"""prefs AS (
  SELECT r.uid, r.channelids, lower(c.c_mktsegment) AS languages
  FROM (SELECT o_custkey AS uid, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS channelids
        FROM orders GROUP BY o_custkey) r
  JOIN customer c ON c.c_custkey = r.uid)"""


@derived
def device_prices(t: Tables) -> DataFrame:
    """Device price lookup keyed by device key."""
    d = device_text(t.part)
    return (d.groupBy(C.device_key("dtype").alias("id"))
            .agg(F.min("p_retailprice").alias("price"))
            .withColumn("price_range", F.when(F.col("price") < PRICE_LOW_BELOW, "low").otherwise("high")))


def sql_device_key(x: str) -> str:
    u = f"upper(trim({x}))"
    brand = f"split_part({u}, '/', 1)"
    model = f"substr({u}, strpos({u}, '/') + 1)"
    return (f"(CASE WHEN {x} IS NULL THEN NULL WHEN strpos({u}, '/') = 0 THEN {u} "
            f"WHEN contains({model}, {brand}) THEN {model} ELSE {brand} || ' ' || {model} END)")


def sql_device_brand(x: str) -> str:
    u = f"upper(trim({x}))"
    return f"(CASE WHEN {x} IS NULL THEN NULL WHEN strpos({u}, '/') = 0 THEN '' ELSE split_part({u}, '/', 1) END)"


SQL_DEVICEPRICE = f"""deviceprice AS (
  SELECT id, price, CASE WHEN price < {PRICE_LOW_BELOW} THEN 'low' ELSE 'high' END AS price_range
  FROM (SELECT {sql_device_key('dtype')} AS id, min(p_retailprice) AS price
        FROM (SELECT p_brand, p_retailprice, {SQL_DEVICE_TEXT} AS dtype FROM part) d GROUP BY 1) g)"""


# -------------------------------------------------------------------- jobs --
@derived
def job_payloads(t: Tables) -> DataFrame:
    """One queue response per market segment: profile the segment against
    ``all``. ``household`` is already executing and ``machinery`` belongs to
    another app, so the submitted-job filter has work to do. The job id is
    the segment's smallest member id (unique: each customer is in one market
    segment)."""
    by_market = members(t).filter(~F.col("segment_id").isin("all", "urgent_buyers"))
    seg = by_market.groupBy("segment_id").agg(F.min("uid").alias("job_id"))
    job = F.struct(
        F.col("job_id").cast("double").alias("jobId"),
        F.when(F.col("segment_id") == "household", "EXECUTING").otherwise("SUBMITTED").alias("jobStatus"),
        F.create_map(F.lit("segmentid"), F.col("segment_id"),
                     F.lit("app"), F.when(F.col("segment_id") == "machinery", "otherapp").otherwise(APP),
                     F.lit("segmentid_compare"), F.lit("all")).alias("inputData"),
        F.lit(RET_AS_OF).cast("timestamp").alias("requested_at"))
    return seg.select(F.to_json(F.struct(F.array(job).alias("response"))).alias("payload"))


SQL_JOBS = f"""jobs AS (
  SELECT CAST(min(uid) AS INTEGER) AS job_id,
         CASE WHEN segment_id = 'household' THEN 'EXECUTING' ELSE 'SUBMITTED' END AS job_status,
         segment_id, CASE WHEN segment_id = 'machinery' THEN 'otherapp' ELSE '{APP}' END AS app,
         'all' AS segment_compare
  FROM members WHERE segment_id NOT IN ('all', 'urgent_buyers') GROUP BY segment_id)"""


# -------------------------------------------------------------------- reads --
@derived
def reads(t: Tables) -> DataFrame:
    """Line items as article reads: the reader is the ordering customer and
    the URL is built from the part's type and name."""
    li, o, p = t.lineitem, t.orders, t.part
    url = F.concat(F.lit("http://shop.example.com/"), F.lower("p_type"), F.lit("/"),
                   F.regexp_replace("p_name", " ", "-"), F.lit("/"), F.col("p_partkey").cast("string"))
    return (li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
            .select(F.col("o_custkey").alias("uid"), F.lit("read").alias("mevent"),
                    F.col("l_shipdate").alias("ts"), url.alias("aurl")))


SQL_READS = """reads AS (
  SELECT o.o_custkey AS uid, 'read' AS mevent, l.l_shipdate AS ts,
         'http://shop.example.com/' || lower(p.p_type) || '/' || replace(p.p_name, ' ', '-') || '/'
           || CAST(p.p_partkey AS VARCHAR) AS aurl
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey)"""


#: Every section of the news taxonomy, and one that no category knows.
NEWS_SECTIONS = tuple(sorted({s for c in NEWS_TAXONOMY for s in (*c.section1, *c.section2)})) + ("weather",)


@derived
def news_reads(t: Tables) -> DataFrame:
    """Line items as reads of news pages: larger ones lie in a section that the
    reader keeps returning to, the others in one set by the part; the
    supplier sets the second section."""
    li, o, n = t.lineitem, t.orders, len(NEWS_SECTIONS)
    section = F.array(*[F.lit(s) for s in NEWS_SECTIONS])
    first = F.when(F.col("l_quantity") > 20, F.col("o_custkey")).otherwise(F.col("l_partkey"))
    url = F.concat(F.lit("http://news.example.com/"), F.get(section, (first % n).cast("int")), F.lit("/"),
                   F.get(section, (F.col("l_suppkey") % n).cast("int")), F.lit("/"), F.col("l_partkey").cast("string"))
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .select(F.col("o_custkey").alias("uid"), F.lit("read").alias("mevent"),
                    F.col("l_shipdate").alias("ts"), url.alias("aurl")))


_SQL_SECTIONS = "[" + ", ".join(f"'{s}'" for s in NEWS_SECTIONS) + "]"
SQL_NEWS_READS = f"""reads AS (
  SELECT o.o_custkey AS uid, 'read' AS mevent, l.l_shipdate AS ts,
         concat_ws('/', 'http://news.example.com',
                   {_SQL_SECTIONS}[1 + (CASE WHEN l_quantity > 20 THEN o_custkey ELSE l_partkey END) % {len(NEWS_SECTIONS)}],
                   {_SQL_SECTIONS}[1 + l_suppkey % {len(NEWS_SECTIONS)}], l_partkey) AS aurl
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


# ------------------------------------------------------------------- events --
EVENT_NAMES = {"signup": "install", "view": "read", "click": "notification_open",
               "purchase": "share_purchase", "error": "settings_changed"}


@derived
def app_events(t: Tables) -> DataFrame:
    """The events table in the app's vocabulary: ``eventid, uid, timestamp,
    mevent, dataused``."""
    e = t.events
    name = F.col("event_type")
    mapped = None
    for k, v in EVENT_NAMES.items():
        mapped = (F.when(name == k, v) if mapped is None else mapped.when(name == k, v))
    return e.select(F.col("event_id").alias("eventid"), F.col("user_id").alias("uid"),
                    F.col("ts").alias("timestamp"), mapped.otherwise(name).alias("mevent"),
                    F.col("value").alias("dataused"))


SQL_APP_EVENTS = "app_events AS (SELECT event_id AS eventid, user_id AS uid, ts AS timestamp, CASE " + " ".join(
    f"WHEN event_type = '{k}' THEN '{v}'" for k, v in EVENT_NAMES.items()) + \
    " ELSE event_type END AS mevent, value AS dataused FROM events)"


@derived
def app_signups(t: Tables) -> DataFrame:
    """The events table for retention: ``uid, ts, mevent`` with sign-ups as
    installs."""
    e = t.events
    return e.select(F.col("user_id").alias("uid"), "ts",
                    F.when(F.col("event_type") == "signup", "install").otherwise(F.col("event_type")).alias("mevent"))


EVENTS_AS_OF = "2024-01-31"


@derived
def events_with_gaps(t: Tables) -> DataFrame:
    """Events with nulls, blanks and NaN made from the data: error events lose
    their type, their value becomes NaN, and clicks get a blank ``props``."""
    e = t.events
    return e.select(
        "event_id", F.col("user_id").alias("uid"), "ts",
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("mevent"),
        F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value")).alias("value"),
        F.when(F.col("event_type") == "click", F.lit("")).otherwise(F.col("props")).alias("props"))


SQL_GAPS = """gaps AS (
  SELECT event_id, user_id AS uid, ts, nullif(event_type, 'error') AS mevent,
         CASE WHEN event_type = 'error' THEN 'NaN'::DOUBLE ELSE value END AS value,
         CASE WHEN event_type = 'click' THEN '' ELSE props END AS props
  FROM events)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


#: The columns whose blanks a quality profile counts.
QUALITY_COLUMNS = ("acategory", "mevent", "aurl", "screen", "network", "luser", "location")


@derived
def event_records(t: Tables) -> DataFrame:
    """Events with all columns of a quality profile. Users that are no customer
    have no network, name or place; purchases have a blank screen, sign-ups no
    category and only views a URL."""
    g, c = events_with_gaps(t), t.customer
    kind = F.col("mevent")
    place = c.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return (g.join(place, g.uid == F.col("c_custkey"), "left")
            .select("uid", "mevent", F.when(kind != "signup", F.col("props")).alias("acategory"),
                    F.when(kind == "view", F.concat(F.lit("http://shop.example.com/"), F.col("event_id").cast("string"))).alias("aurl"),
                    F.when(kind == "purchase", F.lit("")).otherwise(kind).alias("screen"),
                    F.lower("c_mktsegment").alias("network"), F.col("c_name").alias("luser"), F.col("n_name").alias("location")))


SQL_RECORDS = """records AS (
  SELECT g.uid, g.mevent, CASE WHEN g.mevent <> 'signup' THEN g.props END AS acategory,
         CASE WHEN g.mevent = 'view' THEN 'http://shop.example.com/' || g.event_id END AS aurl,
         CASE g.mevent WHEN 'purchase' THEN '' ELSE g.mevent END AS screen,
         lower(c.c_mktsegment) AS network, c.c_name AS luser, n.n_name AS location
  FROM gaps g LEFT JOIN customer c ON g.uid = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""
