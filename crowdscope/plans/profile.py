"""Segment profiles: feature shares, top values, segment comparison and the
JSON report (C2-C5).

All segments and all jobs are rows, so one plan profiles any number of them.

Plan shape for the shares (one pass over the members x profile join):
  * each profile row becomes its ``(uid, feature, value)`` entries through one
    ``inline`` generator, and repeated entries collapse (partial aggregate
    first), so a uid that repeats in the base counts once per value;
  * members are distinct per segment (partial aggregate first, so a repeated
    id collapses before the shuffle) and join the entries on ``uid``;
  * one ``groupBy(segment_id, feature, value)`` with a map-side partial
    count; a value holding a third of all users is just a bigger partial
    count, never a bigger task;
  * the top values are ranked on the user counts, before the segment sizes
    are joined, so the per-group limit runs on both sides of its exchange;
    segment sizes are a small aggregate of the members alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crowdscope.functions import columns as C
from crowdscope.operators.bitmaps import bitmap_users, merge_bitmaps, numbered_state
from crowdscope.operators.hotkeys import HOT_ROWS, left_join_hot

# --- Fixed values: report feature ids and display names, in report order ---
FEATURES: tuple[tuple[str, str], ...] = (
    ("asource", "Acquisition Source"),
    ("aversion", "App Version"),
    ("localecity", "City"),
    ("osversion", "OS Version"),
    ("scresolution", "Screen Resolution"),
    ("install_day", "Day of Install"),
    ("languages", "Language"),
    ("Device_brand", "Device Brand"),
    ("device_price", "Device Price"),
    ("Publication", "Publication"),
)
TOP_K = 10
# ---------------------------------------------------------------------------

BASE_COLUMNS = ("uid", "asource", "aversion", "localecity", "osversion", "scresolution", "dtype",
                "idate", "dtype2", "price", "price_range", "channelids", "languages")


def profile_base(profiles: DataFrame, prefs: DataFrame, prices: DataFrame) -> DataFrame:
    """Profiles with preferences and device price.

    The device-price lookup is joined on the computed device key. Its size
    is whatever the lookup holds, so no broadcast is forced: AQE broadcasts
    it when the measured size is under the threshold and keeps a sort-merge
    join otherwise.
    """
    p = profiles.withColumn("dtype2", C.device_key("dtype"))
    price = prices.select(F.col("id").alias("dtype2"), "price", "price_range")
    return (p.join(prefs.select("uid", "channelids", "languages"), "uid", "left")
            .join(price, "dtype2", "left")
            .select(*BASE_COLUMNS))


def segment_left_join(members: DataFrame, base: DataFrame) -> DataFrame:
    """Every member row with its profile; unmatched ids give an all-null
    profile, and ``uid`` is the profile's id (null when unmatched) (J3)."""
    m = members.select("segment_id", F.col("uid").alias("member_uid"))
    return m.join(base, m.member_uid == base.uid, "left").drop("member_uid")


def segment_left_join_hot(members: DataFrame, base: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """:func:`segment_left_join` where one id may hold a third of all member
    rows and ids may have no profile."""
    profiles = base.withColumn("_key", F.col("uid"))
    m = members.select("segment_id", F.col("uid").alias("_key"))
    return left_join_hot(m, profiles, "_key", hot_rows).drop("_key").select("segment_id", *base.columns)


#: Features computed from the base; the others are columns of the same name.
_COMPUTED = {"install_day": lambda: C.install_weekday("idate"), "Device_brand": lambda: C.device_brand("dtype"),
             "device_price": lambda: F.col("price_range")}
_SCALARS = tuple(fid for fid, _ in FEATURES if fid != "Publication")


def _scalar_values() -> Column:
    """The values of the nine scalar features of a row of the base, null as ``Not_Available``."""
    return F.array(*[F.coalesce((_COMPUTED[n]() if n in _COMPUTED else F.col(n)).cast("string"), F.lit(C.NOT_AVAILABLE)) for n in _SCALARS])


def _entries(values: Column, channelids: Column) -> Column:
    """The ``(feature, value)`` entries of a row: its scalar features and every listed publication."""
    entry = lambda name, v: F.struct(F.lit(name).alias("feature"), v.alias("value"))
    pubs = F.coalesce(F.transform(F.split(channelids, ",", -1), lambda x: entry("Publication", F.coalesce(x, F.lit(C.NOT_AVAILABLE)))),
                      F.array().cast("array<struct<feature:string,value:string>>"))
    return F.concat(F.array(*[entry(n, values[i]) for i, n in enumerate(_SCALARS)]), pubs)


def feature_entries(base: DataFrame) -> DataFrame:
    """Distinct ``(uid, feature, value)`` of the base."""
    return base.filter(F.col("uid").isNotNull()).select("uid", F.inline(_entries(_scalar_values(), F.col("channelids")))).distinct()


def segment_sizes(members: DataFrame) -> DataFrame:
    """Member rows per segment, duplicates included (the share denominator)."""
    return members.groupBy("segment_id").agg(F.count(F.lit(1)).alias("members"))


def feature_counts(members: DataFrame, base: DataFrame) -> DataFrame:
    """``(segment_id, feature, feature_values, users)``: distinct matched
    users per value (A5, P15). Members without a profile have null features,
    so their segment gets a ``Not_Available`` row for each scalar feature,
    with 0 users when nobody else is in that group."""
    ids = members.select("segment_id", F.col("uid").alias("member_uid")).distinct()
    entries = feature_entries(base)
    found = (ids.join(entries, ids.member_uid == entries.uid, "left")
             .groupBy("segment_id", "feature", "value").agg(F.count("uid").alias("users")))
    names = F.when(F.col("feature").isNull(), F.array(*[F.lit(n) for n in _SCALARS])).otherwise(F.array("feature"))
    return (found.select("segment_id", F.explode(names).alias("feature"),
                         F.coalesce("value", F.lit(C.NOT_AVAILABLE)).alias("feature_values"), "users")
            .groupBy("segment_id", "feature", "feature_values").agg(F.sum("users").alias("users")))


def feature_bitmaps(members: DataFrame, base: DataFrame, dictionary: DataFrame, day: str = "day") -> DataFrame:
    """State of distinct users per segment, feature, value and day (A5, A16):
    bitmaps over the numbers of ``dictionary``. ``base`` has a row per user and
    day on which the profile was seen. Profiles meet members and numbers as
    one row each; their entries are made behind the joins, and an entry that
    repeats sets its bit again."""
    ids = members.select("segment_id", "uid").distinct()
    seen = base.filter(F.col("uid").isNotNull()).select("uid", day, _scalar_values().alias("values"), "channelids").distinct()
    numbered = (seen.join(dictionary, "uid").join(ids, "uid")
                .select("segment_id", day, "bit", F.inline(_entries(F.col("values"), F.col("channelids")))))
    return numbered_state(numbered, ["segment_id", "feature", "value", day], dictionary)


def bitmap_feature_counts(state: DataFrame, members: DataFrame) -> DataFrame:
    """:func:`feature_counts` of the days in ``state``, from bitmaps alone.
    Every profile has one value or more of each scalar feature, so the users
    of one such feature are all matched members; a segment with others gets
    the ``Not_Available`` rows of members without a profile."""
    keys = ["segment_id", "feature", "value"]
    users = bitmap_users(merge_bitmaps(state, keys), keys)
    matched = bitmap_users(merge_bitmaps(state.filter(F.col("feature") == _SCALARS[0]), ["segment_id"]), ["segment_id"], "matched")
    ids = members.select("segment_id", "uid").distinct().groupBy("segment_id").agg(F.count(F.lit(1)).alias("ids"))
    lacking = ids.join(matched, "segment_id", "left").filter(F.col("ids") > F.coalesce("matched", F.lit(0)))
    blank = lacking.select("segment_id", F.explode(F.array(*[F.lit(n) for n in _SCALARS])).alias("feature"),
                           F.lit(C.NOT_AVAILABLE).alias("value"), F.lit(0).cast("long").alias("users"))
    return (users.unionByName(blank).groupBy("segment_id", "feature", F.col("value").alias("feature_values"))
            .agg(F.sum("users").alias("users")))


def counted(members: DataFrame, base: DataFrame) -> tuple[DataFrame, DataFrame]:
    """User counts per value and segment sizes: the input of the reports."""
    return feature_counts(members, base), segment_sizes(members)


def with_shares(counts: DataFrame, sizes: DataFrame) -> DataFrame:
    """Counts over their segment's member rows (A16). The sizes are one row
    per segment; no broadcast is forced."""
    extra = [c for c in counts.columns if c not in ("segment_id", "feature", "feature_values", "users")]
    return (counts.join(sizes, "segment_id")
            .select("segment_id", "feature", "feature_values",
                    (F.col("users") / F.col("members")).alias("perc_users"), *extra))


def feature_shares(members: DataFrame, base: DataFrame) -> DataFrame:
    """``(segment_id, feature, feature_values, perc_users)`` for every value
    of the ten features (C3): distinct matched users over the segment's
    member rows."""
    return with_shares(*counted(members, base))


def top_features(counts: DataFrame, sizes: DataFrame, k: int = TOP_K) -> DataFrame:
    """Top ``k`` values per segment and feature by share, ties broken by
    value (W1, L1). Within a segment the share orders as the user count does,
    so the rank needs the counts only and Spark puts a partial per-group
    limit before the shuffle."""
    w = Window.partitionBy("segment_id", "feature").orderBy(F.desc("users"), F.asc("feature_values"))
    best = counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return with_shares(best, sizes)


def segment_compare(jobs: DataFrame, counts: DataFrame, sizes: DataFrame, k: int = TOP_K) -> DataFrame:
    """For each job, the base segment's top values with the comparison
    segment's share of the same value, 0 when it has none (C4, J7, P16)."""
    return _compare(jobs, top_features(counts, sizes, k), with_shares(counts, sizes))


def _compare(jobs: DataFrame, top: DataFrame, shares: DataFrame) -> DataFrame:
    base = (jobs.select("job_id", "segment_id", "segment_compare")
            .join(top.select("segment_id", "feature", "feature_values", "perc_users"), "segment_id"))
    other = shares.select(F.col("segment_id").alias("segment_compare"), "feature", "feature_values",
                          F.col("perc_users").alias("perc_users_compare"))
    return (base.join(other, ["segment_compare", "feature", "feature_values"], "left")
            .na.fill(0.0, ["perc_users_compare"])
            .select("job_id", "segment_id", "segment_compare", "feature", "feature_values",
                    "perc_users", "perc_users_compare"))


def _value_map(value: str, share: str) -> Column:
    """Sorted ``{value: share}`` map from the rows of one group."""
    return F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(value), F.col(share)))))


def profile_json(counts: DataFrame, sizes: DataFrame, k: int = TOP_K) -> DataFrame:
    """``(segment_id, feature, data)``: the top values of a feature as one
    JSON object with sorted keys (K7, F19). Each group holds at most ``k``
    entries."""
    top = top_features(counts, sizes, k)
    return (top.groupBy("segment_id", "feature")
            .agg(F.to_json(_value_map("feature_values", "perc_users")).alias("data")))


def _feature_list() -> Column:
    return F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(fid).alias("id"), F.lit(name).alias("name"))
                     for i, (fid, name) in enumerate(FEATURES)])


def profile_report(jobs: DataFrame, counts: DataFrame, sizes: DataFrame, k: int = TOP_K,
                   compared: DataFrame | None = None) -> DataFrame:
    """One row per job: ``job_id, segment_id, segment_compare, result,
    result_compare``; each result is a JSON array of ten
    ``{id, name, display: "bar", data: {value: share}}`` objects, ``data``
    being ``{}`` for a feature without rows (C5, F20). ``compared`` is the
    jobs' :func:`segment_compare`, if it is there already."""
    top = top_features(counts, sizes, k)
    base_maps = (top.groupBy("segment_id", "feature")
                 .agg(_value_map("feature_values", "perc_users").alias("data")))
    cmp = _compare(jobs, top, with_shares(counts, sizes)) if compared is None else compared
    cmp_maps = (cmp.groupBy("job_id", "feature")
                .agg(_value_map("feature_values", "perc_users_compare").alias("data_compare")))
    slots = (jobs.select("job_id", "segment_id", "segment_compare", F.inline(_feature_list()))
             .withColumnRenamed("id", "feature"))
    empty = F.create_map().cast("map<string,double>")
    rows = (slots.join(base_maps, ["segment_id", "feature"], "left")
            .join(cmp_maps, ["job_id", "feature"], "left"))

    def item(data: str) -> Column:
        return F.struct(F.col("pos"), F.struct(F.col("feature").alias("id"), F.col("name"),
                                               F.lit("bar").alias("display"),
                                               F.coalesce(F.col(data), empty).alias("data")).alias("item"))

    by_pos = lambda a, b: F.when(a["pos"] < b["pos"], -1).when(a["pos"] > b["pos"], 1).otherwise(0)
    ordered = lambda c: F.to_json(F.transform(F.array_sort(F.collect_list(c), by_pos), lambda x: x["item"]))
    return (rows.groupBy("job_id", "segment_id", "segment_compare")
            .agg(ordered(item("data")).alias("result"), ordered(item("data_compare")).alias("result_compare")))


REPORT_SCHEMA = "array<struct<id: string, name: string, display: string, data: map<string, double>>>"


def report_entries(reports: DataFrame) -> DataFrame:
    """Reports back to rows: ``job_id, side, pos, feature, name, display,
    feature_values, share``; a feature with empty ``data`` keeps one row
    with null value and share."""
    sides = [reports.select("job_id", F.lit(side).alias("side"),
                            F.posexplode(F.from_json(F.col(side), REPORT_SCHEMA)).alias("pos", "it"))
             for side in ("result", "result_compare")]
    both = sides[0].unionByName(sides[1])
    return both.select("job_id", "side", "pos", F.col("it.id").alias("feature"), F.col("it.name").alias("name"),
                       F.col("it.display").alias("display"),
                       F.explode_outer("it.data").alias("feature_values", "share"))


def jobs_members(jobs: DataFrame, members: DataFrame) -> DataFrame:
    """Members of the segments that the jobs name (a semi join)."""
    wanted = (jobs.select(F.col("segment_id")).unionByName(jobs.select(F.col("segment_compare").alias("segment_id")))
              .distinct())
    return members.join(wanted, "segment_id", "left_semi")


def jobs_profiles(jobs: DataFrame, members: DataFrame, base: DataFrame, k: int = TOP_K) -> DataFrame:
    """Profile reports for a batch of jobs: only segments named by the jobs
    are profiled."""
    return profile_report(jobs, *counted(jobs_members(jobs, members), base), k)
