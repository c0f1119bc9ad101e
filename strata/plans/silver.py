"""Silver layer: bronze slice -> typed, cleaned, one row per key, hashed,
quality-checked; then merged into the silver table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from strata.operators.dedup import latest_by_key
from strata.operators.projection import (
    INGESTION_TS, ROW_HASH, typed_projection, with_calendar_split, with_row_hash,
)
from strata.operators.quality import apply_quality
from strata.operators.watermark import slice_since
from strata.registry import TableSpec


def silver_columns(spec: TableSpec) -> list[str]:
    return [*spec.column_names, INGESTION_TS, ROW_HASH, "year", "month"]


def silver_dataset(bronze: DataFrame, spec: TableSpec, watermark: dt.datetime | None,
                   collapse: str = "first") -> DataFrame:
    """The incremental silver rows of one table.

    1. rows ingested strictly after ``watermark`` (written before the dedup:
       the optimiser cannot move a filter below an aggregation on other keys);
    2. cast to the registry types and clean text *before* deduplicating, so
       two raw spellings of one key collapse;
    3. newest row per primary key (ties broken by the row's values);
    4. row hash over the typed columns, year/month of ingestion;
    5. data-quality rules on the typed values.
    """
    sliced = slice_since(bronze, INGESTION_TS, watermark)
    typed = typed_projection(sliced, spec, collapse=collapse, keep=[INGESTION_TS])
    latest = latest_by_key(typed, spec.primary_key, [INGESTION_TS])
    out = with_calendar_split(with_row_hash(latest, spec))
    return apply_quality(out, spec.data_quality).select(*silver_columns(spec))
