"""Calendar attributes for the date dimension (Monday = 0, ISO weeks)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(d: Column | str) -> Column:
    """yyyymmdd as an int, by arithmetic (no string formatting)."""
    x = _col(d)
    return (F.year(x) * 10000 + F.month(x) * 100 + F.dayofmonth(x)).cast("int")


def key_to_date(k: Column | str) -> Column:
    x = _col(k)
    return F.make_date(F.floor(x / 10000).cast("int"), (F.floor(x / 100) % 100).cast("int"),
                       (x % 100).cast("int"))


def day_of_week(d: Column | str) -> Column:
    """0 = Monday .. 6 = Sunday."""
    return F.weekday(_col(d))


def is_weekend(d: Column | str) -> Column:
    return F.weekday(_col(d)) >= 5


def month_name(d: Column | str) -> Column:
    """Full English month name."""
    return F.date_format(_col(d), "MMMM")


def day_name(d: Column | str) -> Column:
    """Full English day name."""
    return F.date_format(_col(d), "EEEE")


def week_of_year(d: Column | str) -> Column:
    """ISO-8601 week number."""
    return F.weekofyear(_col(d))


def is_month_start(d: Column | str) -> Column:
    return F.dayofmonth(_col(d)) == 1


def is_month_end(d: Column | str) -> Column:
    x = _col(d)
    return x == F.last_day(x)


def year_month(d: Column | str) -> Column:
    return F.date_format(_col(d), "yyyy-MM")
