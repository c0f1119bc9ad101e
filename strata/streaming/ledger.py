"""Ledger of the landing files that a stream has put into bronze.

One append-only log per table: a file is ``open`` from before its rows are appended
to bronze and ``done`` afterwards.  A micro-batch therefore asks the small ledger, not
the bronze history, which of its files are new.  Only a file that was opened and never
done (the run died in between) is looked up in bronze, from the ingestion day on which
it was opened; the append itself is all or nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.plans.pipeline import bronze_schema
from strata.registry import INGESTION_DATE, TableSpec
from strata.sources.store import TableStore

LEDGER = "stream_files"
LEDGER_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("done", T.BooleanType()),
    T.StructField("day", T.DateType())])


def _log(spec: TableSpec) -> str:
    # Streams of different tables run side by side: each writes a folder of its own.
    return f"{LEDGER}/{spec.name}"


def _note(store: TableStore, spec: TableSpec, paths: DataFrame, done: bool) -> None:
    store.append("control", _log(spec), paths.select(
        "path", F.lit(done).alias("done"), F.current_date().alias("day")))


def _in_bronze(store: TableStore, spec: TableSpec, since=None) -> DataFrame:
    bronze = store.read("bronze", spec.name, bronze_schema(spec))
    if since is not None:
        bronze = bronze.where(F.col(INGESTION_DATE) >= F.lit(since))
    return bronze.select(F.col("_batch_id").alias("path")).distinct()


def new_files(store: TableStore, spec: TableSpec, paths: DataFrame) -> DataFrame:
    """The files of ``paths`` (column ``path``, distinct) that are not in bronze, staged
    and noted as open.  A lake without a ledger gets one from its bronze first."""
    if not store.exists("control", _log(spec)) or store.read("control", _log(spec), LEDGER_SCHEMA).isEmpty():
        if not store.exists("bronze", spec.name):
            return open_files(store, spec, paths)
        _note(store, spec, _in_bronze(store, spec), done=True)
    ledger = store.read("control", _log(spec), LEDGER_SCHEMA)
    known = ledger.join(paths, "path", "left_semi").groupBy("path") \
        .agg(F.max("done").alias("done"), F.min("day").alias("day"))
    known = store.stage(known, f"stream-known-{spec.name}")
    done = known.where("done").select("path")
    since = known.where("not done").agg(F.min("day")).first()[0]
    if since is not None and store.exists("bronze", spec.name):
        cut_short = known.where("not done").select("path").join(_in_bronze(store, spec, since), "path", "left_semi")
        done = done.union(cut_short)
    return open_files(store, spec, paths.join(done, "path", "left_anti"))


def open_files(store: TableStore, spec: TableSpec, paths: DataFrame) -> DataFrame:
    fresh = store.stage(paths.select("path"), f"stream-files-{spec.name}")
    _note(store, spec, fresh, done=False)
    return fresh


def close_files(store: TableStore, spec: TableSpec, paths: DataFrame) -> None:
    _note(store, spec, paths, done=True)
