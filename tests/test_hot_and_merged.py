"""Joins with hot keys, interval joins, mergeable distinct counts and quality
measured while writing, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from crowdscope.operators.aggregates import crosstab
from crowdscope.operators.bitmaps import bitmap_state, bitmap_users, extend_dictionary, merge_bitmaps, number_users
from crowdscope.operators.hotkeys import heavy_keys, interval_join, left_join_hot
from crowdscope.session import scratch_path
from crowdscope.sinks.observed import write_with_quality


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_hot_left_join_keeps_every_row(spark):
    left = [(1, f"r{i % 3}") for i in range(500)] + [(k, "x") for k in range(2, 40)] + [(None, "n")] * 7
    right = [(1, "a"), (1, "b"), (2, "c"), (50, "d"), (None, "e")]
    path = scratch_path(spark, "hot-left")
    spark.createDataFrame(left, "k long, l string").write.parquet(path)
    l, r = spark.read.parquet(path), spark.createDataFrame(right, "k long, r string")
    assert [tuple(x) for x in heavy_keys(l.filter("k is not null"), ["k"], 100).collect()] == [(1, 5)]
    assert _rows(left_join_hot(l, r, "k", 100)) == _rows(l.join(r, "k", "left"))
    none = l.filter("k = -1")
    assert left_join_hot(none, r, "k", 100).count() == 0
    assert _rows(left_join_hot(l, r.filter("k = -1"), "k", 100)) == _rows(l.join(r.filter("k = -1"), "k", "left"))


@pytest.mark.parametrize("hot_rows", [5, 10_000])
def test_interval_join_equals_all_pairs(spark, hot_rows):
    rng = random.Random(3)
    points = [(0 if rng.random() < 0.4 else rng.randrange(6), rng.randrange(-60, 60), i) for i in range(300)]
    points += [(0, 7, 1000)] * 20 + [(None, 3, 1), (1, None, 2)]
    spans = [(rng.randrange(6), s, s + rng.randrange(-2, 45), i) for i, s in enumerate(rng.randrange(-70, 60) for _ in range(80))]
    spans += [(None, 0, 9, 900), (1, None, 5, 901)]
    got = interval_join(spark.createDataFrame(points, "k int, at int, p int"),
                        spark.createDataFrame(spans, "k int, a int, b int, s int"), ["k"], "at", "a", "b", 16, hot_rows)
    want = sorted((p, s) for k, at, p in points for k2, a, b, s in spans
                  if None not in (k, at, a) and k == k2 and a <= at < b)
    assert sorted((r.p, r.s) for r in got.collect()) == want


def test_dictionary_is_gapless_and_grows_by_appending(spark):
    first = spark.createDataFrame([(i * 7,) for i in range(200)] * 2 + [(None,)], "uid long")
    path = scratch_path(spark, "dictionary")
    number_users(first, bucket_users=30).write.parquet(path)
    known = spark.read.parquet(path)
    assert sorted(r.bit for r in known.collect()) == list(range(1, 201))
    more = extend_dictionary(known, spark.createDataFrame([(i,) for i in range(300)], "uid long"))
    rows = {r.uid: r.bit for r in more.collect()}
    old = {i * 7 for i in range(200)}
    assert set(rows) == set(range(300)) - old
    assert sorted(rows.values()) == list(range(201, 201 + len(rows)))
    assert extend_dictionary(known, first).count() == 0


def test_bitmaps_of_days_merge_to_distinct_users(spark):
    users = spark.range(70_000).select(F.col("id").alias("uid"))
    path = scratch_path(spark, "dictionary")
    number_users(users).write.parquet(path)
    seen = (users.withColumn("day", F.explode(F.expr("sequence(1, cast(uid % 3 + 1 as int))")))
            .withColumn("g", F.when(F.col("uid") % 2 == 0, "even").otherwise("odd")))
    state = scratch_path(spark, "state")
    bitmap_state(seen.unionByName(seen), ["g", "day"], spark.read.parquet(path)).write.parquet(state)
    days = spark.read.parquet(state)
    got = {(r.g, r.day): r.users for r in bitmap_users(days, ["g", "day"]).collect()}
    want = {(r.g, r.day): r.n for r in seen.groupBy("g", "day").agg(F.count_distinct("uid").alias("n")).collect()}
    assert got == want
    assert {r.g: r.users for r in bitmap_users(merge_bitmaps(days, ["g"]), ["g"]).collect()} == {"even": 35_000, "odd": 35_000}
    assert days.groupBy("g", "day").count().agg(F.max("count")).first()[0] == 3


def test_a_bitmap_is_as_wide_as_its_users_make_it(spark):
    """A value that few users of a block have costs a word for each, in the
    state and when days merge, and tasks grow in number with the blocks."""
    dictionary = spark.range(1, 70_001).select((F.col("id") * 3).alias("uid"), F.col("id").alias("bit"))
    rare = dictionary.filter("bit IN (1, 64, 65, 32768, 32769, 70000)").select("uid", F.lit("rare").alias("g"))
    seen = rare.unionByName(rare).unionByName(dictionary.filter("bit <= 32768").select("uid", F.lit("all").alias("g")))
    state = bitmap_state(seen.withColumn("day", F.col("uid") % 2), ["g", "day"], dictionary)
    words = {(r.g, r.block): r.n for r in merge_bitmaps(state, ["g"]).select("g", "block", F.size("bits").alias("n")).collect()}
    assert words == {("rare", 1): 3, ("rare", 2): 1, ("rare", 3): 1, ("all", 1): 512}
    assert state.filter("g = 'rare'").agg(F.max(F.size("bits"))).first()[0] <= 2
    assert {r.g: r.users for r in bitmap_users(merge_bitmaps(state, ["g"]), ["g"]).collect()} == {"rare": 6, "all": 32_768}
    assert state.limit(0).isEmpty() and merge_bitmaps(state.limit(0), ["g"]).isEmpty()


def test_quality_is_measured_by_the_writing_pass(spark):
    rows = [(1, "", "d1"), (1, None, "d1"), (2, "x", "d2"), (None, "y", "d2")]
    df = spark.createDataFrame(rows, "uid int, screen string, day string")
    path = scratch_path(spark, "quality")
    got = write_with_quality(df, path, ["screen", "day"], partition_by=["day"])
    assert got.first().asDict() == {"rows": 4, "users": 2, "screen": 2, "day": 0}
    assert spark.read.parquet(path).count() == 4
    empty = write_with_quality(df.limit(0), scratch_path(spark, "quality"), ["screen"])
    assert empty.first().asDict() == {"rows": 0, "users": 0, "screen": 0}
    with pytest.raises(ValueError):
        write_with_quality(df, path, ["screen"], mode="append")


def test_crosstab_finds_its_columns(spark):
    df = spark.createDataFrame([("a", 2), ("a", 10), (None, 2), ("b", None), ("a", 2)], "k string, v int")
    got = crosstab(df, "k", "v")
    assert got.columns == ["k_v", "2", "10", "null"]
    assert _rows(got) == [("a", 2, 1, 0), ("b", 0, 0, 1), ("null", 1, 0, 0)]
    with pytest.raises(ValueError):
        crosstab(spark.range(1001).selectExpr("id k", "id v"), "k", "v")
