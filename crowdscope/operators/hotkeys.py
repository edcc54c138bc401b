"""Joins that stay even when a key holds a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of one key that one task should join.
HOT_ROWS = 1_000_000
#: Most keys in a table of hot keys, so that it can be broadcast (about 16 MB).
MAX_HOT = 200_000


def heavy_keys(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """``(*keys, _salts)``: the keys with more than ``hot_rows`` rows and into
    how many parts each is dealt. Counts are exact and combined before the
    shuffle. At most n / hot_rows keys can be hot; ``hot_rows`` is raised to
    n / MAX_HOT where it is lower, so the table is always small."""
    limit = max(hot_rows, -(-df.count() // MAX_HOT))
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit)
    return sizes.select(*keys, F.ceil(F.col("_n") / limit).cast("int").alias("_salts"))


def _salted(df: DataFrame, hot: DataFrame, keys: list[str], salt: Column) -> DataFrame:
    """``df`` with ``_salt``: 0 except for rows of hot keys. The table of hot
    keys has a bound (:func:`heavy_keys`), so ``df`` isn't shuffled here."""
    return (df.join(F.broadcast(hot), keys, "left")
            .withColumn("_salt", F.when(F.col("_salts").isNull(), 0).otherwise(salt)).drop("_salts"))


def left_join_hot(left: DataFrame, right: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``left.join(right, key, "left")`` where a key may repeat in ``left``
    without bound. Rows of a hot key are dealt over its parts by their place,
    and the right rows of that key stand in each of them; other rows are
    joined as they are. Rows without a key match nothing and take no part in
    the shuffle. ``left`` must be a scan or a written table (a row's place is
    then the same if its task runs again)."""
    known = left.filter(F.col(key).isNotNull())
    hot = heavy_keys(known, [key], hot_rows)
    place = F.pmod(F.monotonically_increasing_id(), F.col("_salts")).cast("int")
    parts = (right.join(F.broadcast(hot), key, "left")
             .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts"))
    joined = _salted(known, hot, [key], place).join(parts, [key, "_salt"], "left").drop("_salt")
    return joined.unionByName(left.filter(F.col(key).isNull()), allowMissingColumns=True)


def interval_join(points: DataFrame, intervals: DataFrame, keys: list[str], at: str, start: str, end: str,
                  width: int, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Pairs of equal ``keys`` with ``start <= at < end``, all whole numbers
    (J6). An interval stands in every bin of ``width`` that it touches, a
    point in its own, so keys and bin are joined by equality and only pairs
    within a bin are compared. A hot (keys, bin) group has its points dealt by
    a hash of the row. Empty intervals and nulls match nothing. Apart from the
    keys the two sides must not share column names."""
    bin_of = lambda c: F.floor(c / F.lit(width)).cast("long")
    placed = points.filter(F.col(at).isNotNull()).withColumn("_bin", bin_of(F.col(at)))
    for k in keys:
        placed = placed.filter(F.col(k).isNotNull())
    hot = heavy_keys(placed, [*keys, "_bin"], hot_rows)
    placed = _salted(placed, hot, [*keys, "_bin"], F.pmod(F.xxhash64(*points.columns), F.col("_salts")).cast("int"))
    spans = (intervals.filter(F.col(start) < F.col(end))
             .withColumn("_bin", F.explode(F.sequence(bin_of(F.col(start)), bin_of(F.col(end) - 1))))
             .join(F.broadcast(hot), [*keys, "_bin"], "left")
             .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts"))
    return (placed.join(spans, [*keys, "_bin", "_salt"])
            .filter((F.col(at) >= F.col(start)) & (F.col(at) < F.col(end))).drop("_bin", "_salt"))
