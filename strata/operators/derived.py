"""Registry derived columns (``name -> Spark SQL expression``)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.registry import TableSpec

AS_OF = "_as_of"


def with_derived(df: DataFrame, spec: TableSpec, as_of: dt.date | None = None) -> DataFrame:
    """Add the table's derived columns.  ``_as_of`` in an expression is the
    given date, or ``current_date()`` when none is given."""
    if not spec.derived_columns:
        return df
    needs_as_of = any(AS_OF in e for e in spec.derived_columns.values())
    out = df
    if needs_as_of:
        out = out.withColumn(AS_OF, F.lit(as_of) if as_of is not None else F.current_date())
    out = out.withColumns({n: F.expr(e) for n, e in spec.derived_columns.items()})
    return out.drop(AS_OF) if needs_as_of else out
