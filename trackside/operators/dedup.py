"""Duplicate control.

``dedup_object_key`` reproduces the lake's last-writer-wins behaviour when
two movements map to one object name (same London second, same operator).
It is a window over each key: one exchange of the rows and one sort after it.
(``max_by`` of a whole row cannot be hash-aggregated: it sorts every row both
before and after the exchange, and with keys that are nearly unique the
first step removes nothing.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedup_object_key(df: DataFrame, order_cols: list[str],
                     keys: list[str] | None = None) -> DataFrame:
    """One row per object key: the last in ``order_cols`` order (arrival order)."""
    keys = keys or ["year", "month", "day", "object_name"]
    last = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order_cols])
    return df.withColumn("_nth", F.row_number().over(last)).where("_nth = 1").drop("_nth")


def dedup_exact(df: DataFrame, keys: list[str]) -> DataFrame:
    """Exact batch de-duplication on ``keys`` (keeps the smallest row per key)."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    return (df.groupBy(*keys).agg(F.min(F.struct(*[F.col(c) for c in rest])).alias("_w"))
            .select(*keys, *[F.col("_w").getField(c).alias(c) for c in rest]))
