"""Deduplication by key with deterministic winners.

Both operators are one aggregation per key over a struct, so Spark combines
map-side before the shuffle: a key that holds a third of all rows reaches the
final reducer as one partial row per map task, never as one giant group, and
no global sort of the rows is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_W = "__winner"


def _pick(df: DataFrame, keys: list[str], order: list[str], agg) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order]
    fields = order + rest
    if not fields:
        return df.select(*keys).distinct()
    win = agg(F.struct(*[F.col(c) for c in fields])).alias(_W)
    out = df.groupBy(*keys).agg(win)
    return out.select(*[F.col(c) if c in keys else F.col(f"{_W}.{c}").alias(c)
                        for c in df.columns])


def latest_by_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """One row per key: the greatest ``order_by`` (e.g. newest ingestion
    timestamp); ties are broken by the remaining columns, so the result does
    not depend on input order.  NULL keys form one group, as in a window."""
    return _pick(df, keys, list(order_by), F.max)


def first_by_key(df: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """One row per key: the smallest ``order_by`` then remaining columns."""
    return _pick(df, keys, list(order_by or []), F.min)
