"""Typed projection, lineage and partition columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.casts import typed_cast
from strata.functions.hashing import raw_row_hash, row_hash
from strata.functions.text import clean_text
from strata.registry import INGESTION_DATE, TableSpec

INGESTION_TS = "_ingestion_timestamp"
BATCH_ID = "_batch_id"
SOURCE_FILE = "_source_file"
RAW_HASH = "_row_hash"
ROW_HASH = "row_hash"


def typed_projection(df: DataFrame, spec: TableSpec, collapse: str = "first",
                     keep: list[str] | None = None) -> DataFrame:
    """Declared columns cast to their registry types; text columns cleaned.

    ``keep`` lists extra columns passed through unchanged (e.g. lineage).
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    exprs = []
    for c, t in spec.columns.items():
        if t.lower() in ("varchar", "string"):
            e = clean_text(F.col(c), collapse)
        else:
            e = typed_cast(c, t, fields.get(c))
        exprs.append(e.alias(c))
    return df.select(*exprs, *[F.col(k) for k in (keep or [])])


def with_row_hash(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``row_hash`` over the declared (typed, cleaned) columns."""
    return df.withColumn(ROW_HASH, row_hash(spec.column_names))


def with_raw_hash(df: DataFrame, cols: list[str]) -> DataFrame:
    """``_row_hash`` over the raw landing columns (one hash for the whole row)."""
    return df.withColumn(RAW_HASH, raw_row_hash(cols))


def with_lineage(df: DataFrame, batch_id: str, source_file=None) -> DataFrame:
    """Ingestion timestamp (one value per query), batch id, source file name."""
    src = F.lit(None).cast("string") if source_file is None else source_file
    return df.withColumns({
        INGESTION_TS: F.current_timestamp(),
        BATCH_ID: F.lit(batch_id),
        SOURCE_FILE: src,
    }).withColumn(INGESTION_DATE, F.to_date(F.col(INGESTION_TS)))


def with_calendar_split(df: DataFrame, ts: str = INGESTION_TS) -> DataFrame:
    """``year`` and ``month`` of the ingestion timestamp."""
    return df.withColumns({"year": F.year(ts), "month": F.month(ts)})
