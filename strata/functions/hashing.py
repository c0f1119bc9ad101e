"""Row hashes used for lineage (bronze) and change detection (silver merge)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separators and the NULL marker of the two hashes.
RAW_SEPARATOR = "|"
ROW_SEPARATOR = "||"
NULL_MARKER = "<<NULL>>"


def _cols(cols: Iterable[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def raw_row_hash(cols: Iterable[Column | str]) -> Column:
    """md5 of the '|'-joined text of the columns; NULLs are skipped."""
    return F.md5(F.concat_ws(RAW_SEPARATOR, *[c.cast("string") for c in _cols(cols)]))


def row_hash(cols: Iterable[Column | str]) -> Column:
    """md5 of the '||'-joined text of the columns, NULL written as a marker, so a
    NULL and a missing value never hash alike."""
    parts = [F.coalesce(c.cast("string"), F.lit(NULL_MARKER)) for c in _cols(cols)]
    return F.md5(F.concat_ws(ROW_SEPARATOR, *parts))
