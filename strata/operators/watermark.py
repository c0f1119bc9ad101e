"""Batch high-water marks: incremental slices and look-back windows.

A watermark here is control data (the newest ingestion time already loaded),
not an event-time streaming watermark.  Only one scalar per table ever
reaches the driver.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MIN_WATERMARK = dt.datetime(1900, 1, 1)
MIN_DATE = dt.date(1900, 1, 1)
LOOKBACK_DAYS = 7

WATERMARK_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("last_watermark", T.TimestampType(), True),
])
PROCESSED_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("last_processed_date", T.DateType(), True),
])


def _literal_like(df: DataFrame, col: str, value):
    """A literal of the column's own type, so the comparison needs no cast
    on the column and stays pushable into the scan."""
    lit = F.lit(value)
    dtype = df.schema[col].dataType
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        return lit.cast(dtype)
    return lit


def slice_since(df: DataFrame, ts_col: str, watermark: dt.datetime | None) -> DataFrame:
    """Rows strictly after the watermark (all rows when there is none)."""
    if watermark is None:
        return df
    return df.where(F.col(ts_col) > _literal_like(df, ts_col, watermark))


def lookback(df: DataFrame, date_col: str, last: dt.date | None,
             days: int = LOOKBACK_DAYS, inclusive: bool = False) -> DataFrame:
    """Rows whose date is after ``last - days`` (``>=`` when inclusive).

    Re-reading a few days before the mark picks up late-arriving rows; the
    merge that follows makes the re-read idempotent.
    """
    if last is None:
        return df
    bound = F.date_sub(F.lit(last), days)
    c = F.col(date_col)
    return df.where(c >= bound if inclusive else c > bound)


def watermark_of(control: DataFrame, table: str, value_col: str = "last_watermark"):
    """Newest mark recorded for ``table`` (None when there is none).  Taking
    the max makes an append-only control table safe to read."""
    row = (control.where(F.col("table_name") == table)
           .agg(F.max(value_col).alias("m")).first())
    return None if row is None else row["m"]


def watermarks_per_table(control: DataFrame, value_col: str = "last_watermark") -> DataFrame:
    """The newest mark of every table (one row per table)."""
    return control.groupBy("table_name").agg(F.max(value_col).alias(value_col))


def slice_stats(df: DataFrame, ts_col: str) -> tuple[int, dt.datetime | None]:
    """(row count, max timestamp) of a slice in one aggregate job."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.max(ts_col).alias("m")).first()
    return int(row["n"]), row["m"]
