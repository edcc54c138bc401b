"""Exact distinct counts that merge: users as bits.

A dictionary numbers the users from 1 without gaps and never renumbers one. A
state holds, per group and block of 32,768 numbers, the bitmap of its users;
states of several days merge by ``or``, so no event is read again.

A bitmap is the list of its words of 64 bits that are not zero, by place. So a
state has at most one word for each user of a group and at most 512 for each
block, and no row that is sorted or dealt is wider than its users make it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Users that one task numbers, on average.
BUCKET_USERS = 50_000
#: Users of one word of a bitmap.
WORD = 64
#: Tasks for each block of users: what a task holds doesn't grow with the users.
BLOCK_TASKS = 4


def number_users(users: DataFrame, first: int = 1, bucket_users: int = BUCKET_USERS) -> DataFrame:
    """``(uid, bit)``: the distinct users numbered from ``first`` without gaps.
    They are dealt over hash buckets and a bucket starts where those before it
    end, so no task sees all users. Null is no user."""
    ids = users.select("uid").filter(F.col("uid").isNotNull()).distinct()
    buckets = max(1, -(-ids.count() // bucket_users))
    dealt = ids.withColumn("_bucket", F.pmod(F.xxhash64("uid"), F.lit(buckets)).cast("int"))
    sizes = dealt.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy("uid"))
    return (dealt.withColumn("_place", place - 1).join(starts, "_bucket")
            .select("uid", (F.col("_start") + F.col("_place") + first).cast("long").alias("bit")))


def extend_dictionary(known: DataFrame, users: DataFrame) -> DataFrame:
    """The rows to append to the dictionary ``known`` for users new to it."""
    last = known.agg(F.coalesce(F.max("bit"), F.lit(0)).alias("last")).first()["last"]
    return number_users(users.select("uid").join(known, "uid", "left_anti"), last + 1)


def _dealt(rows: DataFrame, keys: list[str], last_block: int | None) -> DataFrame:
    """Rows dealt by group and block over as many tasks as there are blocks,
    four times over; the groupings behind it need no other exchange."""
    return rows.repartition(BLOCK_TASKS * ((last_block or 0) + 1), *keys, "block")


def _bitmaps(words: DataFrame, keys: list[str]) -> DataFrame:
    """``(*keys, block, bits)`` of dealt ``(*keys, block, word, set)``, by
    ``or`` of equal words."""
    merged = words.groupBy(*keys, "block", "word").agg(F.bit_or("set").alias("set"))
    return merged.groupBy(*keys, "block").agg(F.sort_array(F.collect_list(F.struct("word", "set"))).alias("bits"))


def numbered_state(numbered: DataFrame, keys: list[str], dictionary: DataFrame) -> DataFrame:
    """:func:`bitmap_state` of rows that have their number of ``dictionary`` (``bit``) already."""
    last = dictionary.agg(F.max(F.bitmap_bucket_number("bit")) - 1).first()[0]
    at = F.bitmap_bit_position("bit").cast("int")
    dealt = _dealt(numbered.select(*keys, F.bitmap_bucket_number("bit").alias("block"), at.alias("_at")), keys, last)
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_at") % WORD)
    return _bitmaps(dealt.select(*keys, "block", F.expr(f"cast(_at div {WORD} as int)").alias("word"), one.alias("set")), keys)


def bitmap_state(rows: DataFrame, keys: list[str], dictionary: DataFrame) -> DataFrame:
    """``(*keys, block, bits)`` of rows with a ``uid``, repeated rows counting
    once. A group with many users is spread over its blocks; a bitmap has 12
    bytes for every 64 numbers of which the group holds one."""
    return numbered_state(rows.select(*keys, "uid").join(dictionary, "uid"), keys, dictionary)


def merge_bitmaps(state: DataFrame, keys: list[str]) -> DataFrame:
    """The state by fewer keys (without the day, say) or of several states."""
    last = state.agg(F.max("block") - 1).first()[0]
    dealt = _dealt(state.select(*keys, "block", "bits"), keys, last)
    return _bitmaps(dealt.select(*keys, "block", F.inline("bits")), keys)


def bitmap_users(state: DataFrame, keys: list[str], name: str = "users") -> DataFrame:
    """Distinct users per group of a merged state."""
    users = F.aggregate("bits", F.lit(0).cast("long"), lambda n, w: n + F.bit_count(w["set"]))
    return state.groupBy(*keys).agg(F.sum(users).alias(name))
