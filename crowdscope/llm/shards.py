"""Sharding by vector bin packing: bytes, tokens and rows balanced jointly."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdscope.llm.common import gapless_rank, land, text_column

#: A group above this part of a shard, in any dimension, is placed by itself:
#: at most 3 * shards / OWN_PART of them exist.
OWN_PART = 1 / 64
#: A group above this part of a shard is split into even pieces below it.
SPLIT_PART = 1 / 2
#: Smaller groups are placed in bundles, by a hash of their text.
BUNDLES = 8192


def place(units: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unit (rows of bytes, tokens, rows), largest unit first:
    the shard whose residual capacity has the highest dot product with it.
    Capacity is an even share of each dimension, so the residuals end near 0."""
    total = units.sum(axis=0)
    share = units / np.where(total > 0, total / shards, 1.0)
    residual = np.ones((shards, units.shape[1]))
    out = np.zeros(len(units), np.int64)
    for i in np.argsort(-share.max(axis=1), kind="stable"):
        s = int(np.argmax(residual @ share[i]))
        out[i] = s
        residual[s] -= share[i]
    return out


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """Deal documents over ``shards`` with near-equal bytes, tokens and rows.

    Returns one row per input row: doc_id, size (UTF-8 bytes of the text plus
    8), text_crc32, tokens (blank-separated words), shard and slot (place in
    the shard, gapless from 0). Documents with equal texts are one group and
    stay together, unless the group exceeds half a shard: then it is split
    into pieces of equally many rows. Groups above 1/64 of a shard are placed one by
    one, the many small ones in bundles of a text hash, so the placement sees
    a bounded number of units at any input size.

    Defined cases: a null text has no bytes or tokens and forms one group with
    crc 0, as does the empty text; null ids and repeated rows are dealt as any
    row, each by its place in the input; groups of equal share are placed in
    order of their hash; an empty table gives no rows; other columns are not looked at.
    """
    text = text_column(docs)
    rows = land(docs.select(
        F.col("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(text.cast("binary"), F.lit(b""))).alias("text_crc32"),
        F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long").alias("tokens"),
        F.xxhash64(text).alias("group"), F.monotonically_increasing_id().alias("place")), "shard-rows")
    groups = rows.groupBy("group").agg(F.sum("size").alias("b"), F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n"))
    whole = rows.agg(F.sum("size"), F.sum("tokens"), F.count(F.lit(1))).first()
    share = F.greatest(*[F.col(c) * (shards / max(1, whole[i] or 0)) for i, c in enumerate("btn")])
    sized = groups.withColumn("share", share).withColumn("own", F.col("share") > OWN_PART)
    big = [(r.group, max(1, int(np.ceil(r.share / SPLIT_PART))), (r.b, r.t, r.n)) for r in sized.where("own").collect()]
    small = [(r.bundle, (r.b, r.t, r.n)) for r in
             sized.where("not own").groupBy(F.pmod("group", F.lit(BUNDLES)).alias("bundle"))
             .agg(F.sum("b").alias("b"), F.sum("t").alias("t"), F.sum("n").alias("n")).collect()]
    spark = docs.sparkSession
    split = spark.createDataFrame([(g, p) for g, p, _ in big] or [(0, 0)], "group long, pieces int")
    split = F.broadcast(split.where("pieces > 0"))
    slim = ["doc_id", "size", "text_crc32", "tokens", "place"]
    keyed = rows.join(split, "group", "left_anti").select(*slim, F.pmod("group", F.lit(BUNDLES)).alias("unit"), F.lit(-1).alias("piece"))
    if big:  # rows of a large group are numbered, so that its pieces differ by one row at most
        own = land(rows.join(split, "group"), "shard-groups")
        dealt = gapless_rank(own, "group", F.xxhash64("place"), [F.col("place")], "rank")
        keyed = keyed.unionByName(dealt.select(*slim, F.col("group").alias("unit"), F.pmod("rank", "pieces").cast("int").alias("piece")))
        keyed = land(keyed, "shard-keyed")
    units = [(int(k), -1, *v) for k, v in small]
    if big:
        pieces = keyed.where("piece >= 0").groupBy("unit", "piece").agg(F.sum("size"), F.sum("tokens"), F.count(F.lit(1)))
        units += [tuple(r) for r in pieces.collect()]
    units.sort()
    plan = [] if not units else place(np.array([u[2:] for u in units], float), shards)
    placed = spark.createDataFrame([(u[0], u[1], int(s)) for u, s in zip(units, plan)] or [(0, -2, 0)],
                                   "unit long, piece int, shard int")
    dealt = land(keyed.join(F.broadcast(placed), ["unit", "piece"]).drop("unit", "piece"), "shard-dealt")
    return gapless_rank(dealt, "shard", F.xxhash64("place"), [F.col("doc_id"), F.col("text_crc32"), F.col("place")], "slot").drop("place")
