"""Safe casts into registry types.

A failed cast gives NULL (never an error), so one malformed CSV field drops to
NULL and the data-quality rules decide whether the row survives.  Text cast to
an integer type rounds (``'3.7'`` -> 4, ``'1e3'`` -> 1000) the way the
reference engine casts text; a double source rounds half to even.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.registry import TYPE_MAP

# A date has a year, a month and a day; Spark alone would also take a part of one.
DATE_TEXT = r"^\s*\d{1,6}-\d{1,2}-\d{1,2}(?:[ T].*)?\s*$"
# Number texts that only Java and Spark take for numbers.
SUFFIXED = r"[dDfF]\s*$"
# A failed try_cast raises and catches an exception inside (some 20 microseconds a row),
# so text that cannot parse is not tried: all texts an exact integer cast takes match
# the first, all that a double cast takes the second.
INTEGER_TEXT = r"^[\x00-\x20\x7F]*[-+]?[0-9]+[\x00-\x20\x7F]*\z"
NUMBER_TEXT = r"[0-9]|[nN][aA][nN]|[iI][nN][fF]"


def typed_cast(c: Column | str, type_name: str,
               source_type: T.DataType | None = None) -> Column:
    """Cast ``c`` to the registry type ``type_name``; NULL when it does not parse."""
    x = F.col(c) if isinstance(c, str) else c
    target = TYPE_MAP[type_name.lower()]
    if source_type == target:
        return x
    if isinstance(target, (T.IntegerType, T.LongType)):
        if isinstance(source_type, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
            return x.try_cast(target)
        if isinstance(source_type, (T.DoubleType, T.FloatType, T.DecimalType)):
            return F.bround(x.try_cast("double")).try_cast(target)
        # text: exact integer first (no precision loss), else round the number
        exact = F.when(x.cast("string").rlike(INTEGER_TEXT), x.try_cast(target))
        return F.coalesce(exact, F.round(_number(x)).try_cast(target))
    if isinstance(source_type, T.StringType) or source_type is None:
        if isinstance(target, (T.DoubleType, T.FloatType)):
            return _number(x).try_cast(target)
        if isinstance(target, T.DateType):
            return F.when(x.rlike(DATE_TEXT), x.try_cast(target))
    return x.try_cast(target)


def _number(x: Column) -> Column:
    """Text as a double, NULL for what is no plain number (``1d``, ``1f``)."""
    text = x.cast("string")
    return F.when(text.rlike(NUMBER_TEXT) & ~text.rlike(SUFFIXED), x.try_cast("double"))
