"""Reshaping: list explode, unpivot and union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def list_explode(df: DataFrame, ids: list[str], list_col: str, max_items: int | None = None, sep: str = ",",
                 value: str = "value") -> DataFrame:
    """One row per item of a delimited list, all of them or the first ``max_items``, with
    its 0-based position (R1, F1). An empty text is one empty item; a null
    list gives no rows."""
    items = F.split(F.col(list_col), sep, -1)
    if max_items is not None:
        items = F.slice(items, 1, max_items)
    return df.select(*ids, F.posexplode(items).alias("pos", value))


def list_columns(df: DataFrame, ids: list[str], list_col: str, n: int = 30, sep: str = ",",
                 prefix: str = "col") -> DataFrame:
    """Items 0..n-1 of a list as columns ``col1..colN``; null past the end (F2)."""
    arr = F.split(F.col(list_col), sep, -1)
    return df.select(*ids, *[F.get(arr, i).alias(f"{prefix}{i + 1}") for i in range(n)])


def unpivot_columns(df: DataFrame, ids: list[str], columns: list[str], name: str = "name",
                    value: str = "value") -> DataFrame:
    """Wide -> long in one pass (R2). Columns are cast to one common type by
    Spark; mixed types should be cast by the caller."""
    return df.unpivot(ids, columns, name, value)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """``UNION ALL`` by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def feature_union(df: DataFrame, ids: list[str], features: list[str]) -> DataFrame:
    """Long ``(ids..., feature, value)`` as a union of one branch per feature
    (U1). Kept for API parity; :func:`unpivot_columns` reads the input once."""
    return union_all([df.select(*ids, F.lit(f).alias("feature"), F.col(f).cast("string").alias("value"))
                      for f in features])
