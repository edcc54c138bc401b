import json

import pytest
from pyspark.sql import functions as F

from crowdscope.plans import inputs as I
from crowdscope.plans import profile as P
from tests.conftest import SF01

BASE_SCHEMA = ("uid string, asource string, aversion string, localecity string, osversion string, "
               "scresolution string, dtype string, idate string, dtype2 string, price double, "
               "price_range string, channelids string, languages string")


def _base(spark, rows):
    full = []
    for r in rows:
        d = dict(uid=None, asource=None, aversion=None, localecity=None, osversion=None, scresolution=None,
                 dtype=None, idate=None, dtype2=None, price=None, price_range=None, channelids=None, languages=None)
        d.update(r)
        full.append(tuple(d[c] for c in P.BASE_COLUMNS))
    return spark.createDataFrame(full, BASE_SCHEMA)


def _members(spark, rows):
    return spark.createDataFrame(rows, "segment_id string, uid string")


def test_shares_denominator_duplicates_unmatched_nulls(spark):
    base = _base(spark, [
        dict(uid="a", asource="play", localecity="Delhi", channelids="p1,p2", idate="27-04-2017",
             dtype="samsung/galaxy"),
        dict(uid="b", asource="play", localecity=None, channelids="", idate="x"),
        dict(uid="c", asource="ios", localecity="Not_Available", channelids=None),
    ])
    members = _members(spark, [("s", "a"), ("s", "a"), ("s", "b"), ("s", "c"), ("s", "ghost")])
    sh = {(r.feature, r.feature_values): r.perc_users for r in P.feature_shares(members, base).collect()}
    n = 5.0                                             # member rows, duplicates and unmatched included
    assert sh[("asource", "play")] == 2 / n
    assert sh[("asource", "ios")] == 1 / n
    assert sh[("asource", "Not_Available")] == 0.0      # the unmatched id: null group, no user
    assert sh[("localecity", "Not_Available")] == 2 / n  # null and literal Not_Available merge (one group)
    assert sh[("Publication", "p1")] == 1 / n
    assert sh[("Publication", "")] == 1 / n             # empty list is one empty publication
    assert ("Publication", "Not_Available") not in sh   # null lists give no publication rows
    assert sh[("install_day", "Thursday")] == 1 / n
    assert sh[("install_day", "Not_Available")] == 2 / n  # bad text and missing date
    assert sh[("Device_brand", "SAMSUNG")] == 1 / n


def test_top_k_ties_broken_by_value(spark):
    base = _base(spark, [dict(uid=f"u{i}", localecity=f"c{i:02d}") for i in range(12)])
    members = _members(spark, [("s", f"u{i}") for i in range(12)])
    top = P.top_features(*P.counted(members, base)).filter("feature = 'localecity'")
    vals = [r.feature_values for r in top.orderBy("rank").collect()]
    assert vals == [f"c{i:02d}" for i in range(10)]


def test_compare_fills_zero_and_keeps_base_top(spark):
    base = _base(spark, [dict(uid="a", asource="x"), dict(uid="b", asource="y"), dict(uid="c", asource="x")])
    members = _members(spark, [("s", "a"), ("s", "b"), ("t", "c")])
    jobs = spark.createDataFrame([(1, "s", "t")], "job_id int, segment_id string, segment_compare string")
    cmp = P.segment_compare(jobs, *P.counted(members, base)).filter("feature = 'asource'")
    got = {r.feature_values: (r.perc_users, r.perc_users_compare) for r in cmp.collect()}
    assert got == {"x": (0.5, 1.0), "y": (0.5, 0.0)}


def test_report_empty_feature_and_value_named_feature(spark):
    base = _base(spark, [dict(uid="a", asource="feature", channelids=None)])
    members = _members(spark, [("s", "a")])
    jobs = spark.createDataFrame([(7, "s", "s")], "job_id int, segment_id string, segment_compare string")
    rep = P.jobs_profiles(jobs, members, base).first()
    result = json.loads(rep.result)
    assert [x["id"] for x in result] == [f for f, _ in P.FEATURES]
    by_id = {x["id"]: x for x in result}
    assert by_id["Publication"]["data"] == {}
    assert by_id["asource"]["data"] == {"feature": 1.0}
    assert by_id["asource"]["name"] == "Acquisition Source" and by_id["asource"]["display"] == "bar"
    assert json.loads(rep.result_compare)[0]["data"] == {"feature": 1.0}


def test_profile_json_reparses_to_top_features(spark):
    t = I.Tables(spark, SF01)
    base = P.profile_base(I.profiles(t), I.preferences(t), I.device_prices(t))
    shares = P.counted(I.members(t), base)
    top = {(r.segment_id, r.feature, r.feature_values): r.perc_users for r in P.top_features(*shares).collect()}
    again = {}
    for r in P.profile_json(*shares).collect():
        for k, v in json.loads(r.data).items():
            again[(r.segment_id, r.feature, k)] = v
    assert again.keys() == top.keys()
    for k, v in top.items():
        assert again[k] == pytest.approx(v)


def test_single_valued_feature_shares_sum_to_at_most_one(spark):
    t = I.Tables(spark, SF01)
    base = P.profile_base(I.profiles(t), I.preferences(t), I.device_prices(t))
    sums = (P.feature_shares(I.members(t), base).filter("feature <> 'Publication'")
            .groupBy("segment_id", "feature").agg(F.sum("perc_users").alias("s")).collect())
    assert sums and all(r.s <= 1.0 + 1e-9 for r in sums)


def test_duplicated_map_key_clash_is_merged(spark):
    base = _base(spark, [dict(uid="a", osversion=None), dict(uid="b", osversion="Not_Available")])
    members = _members(spark, [("s", "a"), ("s", "b")])
    rows = P.profile_json(*P.counted(members, base)).filter("feature = 'osversion'").collect()
    assert json.loads(rows[0].data) == {"Not_Available": 1.0}


def test_repeated_uid_counts_once_and_member_without_profile_counts_in_the_size(spark):
    base = _base(spark, [dict(uid="u1", asource="x", languages="en"), dict(uid="u1", asource="x", languages="de"),
                         dict(uid="u2", asource="y", languages="en")])
    members = _members(spark, [("s", "u1"), ("s", "u2"), ("s", "nobody"), ("s", "nobody")])
    sh = {(r.feature, r.feature_values): r.perc_users for r in P.feature_shares(members, base).collect()}
    assert sh[("asource", "x")] == 0.25 and sh[("asource", "y")] == 0.25
    assert sh[("languages", "en")] == 0.5 and sh[("languages", "de")] == 0.25
    assert sh[("asource", "Not_Available")] == 0.0
