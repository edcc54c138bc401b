"""Ordering, limits and top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, order: list, k: int) -> DataFrame:
    """``order by ... limit k`` with a full ordering so the result is stable
    (L2). Spark runs it as ``TakeOrderedAndProject``: a per-partition top-k
    and a merge of k rows per partition, never a full sort."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, keys: list[str], order: list, k: int, rank: str = "rank") -> DataFrame:
    """Top ``k`` rows per group by ``order`` (W1, L1); ``row_number() <= k``
    lets Spark put a partial group limit before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)
