"""Incremental landing loads with Structured Streaming.

``readStream`` lists a table's landing folder; every new CSV file is read
exactly once (the stream checkpoint records the files already seen, which
takes the place of the silver watermark table).  ``trigger(availableNow)``
processes everything that has arrived and stops, so the same code runs as a
scheduled batch job or continuously with a processing-time trigger.

Each micro-batch: lineage + quality -> staged in the shared checkpoint
folder -> appended to bronze, unless the ledger (``streaming.ledger``) says that
the file is there -> the batch form's silver load from the table's watermark.  So a batch that is
replayed, also under a new checkpoint, appends nothing twice, and stream and
batch loads may take turns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.plans.pipeline import REJECTS, bronze_frame, rejects, silver_load
from strata.registry import Registry, TableSpec, load_registry
from strata.session import ensure_checkpoint_dir
from strata.sources.landing import CORRUPT, configured_reader, landing_columns, landing_schema
from strata.sources.store import TableStore
from strata.streaming.ledger import close_files, new_files


def _source(spark: SparkSession, spec: TableSpec, folder: str, multi_line: bool) -> DataFrame:
    schema = landing_schema(spark, spec, folder, multi_line, recursive=True)
    reader = (configured_reader(spark.readStream, schema, multi_line)
              .option("maxFilesPerTrigger", 1000).option("recursiveFileLookup", True))
    return landing_columns(reader.csv(folder), spec)


def _batch_writer(spark: SparkSession, store: TableStore, spec: TableSpec, collapse: str, null_safe: bool):
    def write(batch: DataFrame, epoch: int) -> None:
        # A file is one batch of bronze whatever the epoch's number: a batch that is
        # replayed, also after the checkpoint was reset, finds its files in the ledger.
        raw = store.stage(batch, f"stream-{spec.name}")
        whole = raw.where(F.col(CORRUPT).isNull())
        try:
            files = new_files(store, spec, raw.select(F.col("_source_path").alias("path")).distinct())
            whole = whole.join(files, F.col("_source_path") == F.col("path"), "left_semi")
            frame = bronze_frame(whole, spec, F.col("_source_path"))
            bronze = store.stage(frame, f"stream-bronze-{spec.name}")
            store.append("bronze", spec.name, bronze, partition_by=spec.partition_by)
            rejected = raw.where(F.col(CORRUPT).isNotNull()) \
                .join(files, F.col("_source_path") == F.col("path"), "left_semi")
            if not rejected.isEmpty():
                store.append("control", REJECTS, rejects(rejected, spec, F.col("_source_path")))
            close_files(store, spec, files)
            # silver takes what is in bronze and newer than its mark, as the batch form
            silver_load(spark, store, spec, collapse, null_safe)
        finally:
            store.drop_staged()
    return write


def start_table_stream(spark: SparkSession, store: TableStore, spec: TableSpec,
                       landing_dir: str, checkpoint_root: str | None = None,
                       collapse: str = "first", null_safe: bool = True,
                       available_now: bool = True, multi_line: bool = True,
                       processing_time: str = "1 minute") -> StreamingQuery:
    """Start the stream of one table; its landing folder is
    ``<landing_dir>/<table>/`` (any number of CSV files).  ``store`` must not
    be shared with another running stream."""
    root = (checkpoint_root or f"{ensure_checkpoint_dir(spark).rstrip('/')}/strata-streams")
    writer = _batch_writer(spark, store, spec, collapse, null_safe)
    w = (_source(spark, spec, f"{landing_dir.rstrip('/')}/{spec.name}", multi_line).writeStream
         .queryName(f"landing_{spec.name}")
         .option("checkpointLocation", f"{root}/{spec.name}")
         .foreachBatch(writer))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def stream_tables(spark: SparkSession, landing_dir: str, lake_root: str,
                  registry: Registry | None = None, tables: list[str] | None = None,
                  checkpoint_root: str | None = None, collapse: str = "first",
                  null_safe: bool = True) -> None:
    """Process every table's new landing files once (availableNow) and wait."""
    reg = registry or load_registry()
    TableStore(spark, lake_root).ensure_layers()
    # one store per stream: each tracks (and drops) only its own staged batches
    queries = [start_table_stream(spark, TableStore(spark, lake_root), reg.spec(t), landing_dir,
                                  checkpoint_root, collapse, null_safe)
               for t in (tables or list(reg))]
    for q in queries:
        q.awaitTermination()
