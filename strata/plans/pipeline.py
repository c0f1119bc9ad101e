"""The medallion pipeline: landing CSV -> bronze -> silver -> gold -> KPIs.

Each layer function plans DataFrames and writes them through the
``TableStore``; the only values that come back to the driver are scalars
(row counts from write observations, max watermarks, emptiness).  Tables
of one layer are independent jobs; Spark parallelises inside each job.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.dates import key_to_date
from strata.operators.projection import (
    INGESTION_TS, RAW_HASH, with_lineage, with_raw_hash,
)
from strata.operators.quality import apply_quality_raw
from strata.operators.watermark import (
    PROCESSED_SCHEMA, WATERMARK_SCHEMA, slice_since, watermark_of,
)
from strata.operators import kpis
from strata.operators.changes import changed_orders
from strata.plans import gold as gold_plan
from strata.plans.silver import silver_dataset
from strata.registry import INGESTION_DATE, Registry, TableSpec, load_registry
from strata.sources.landing import CORRUPT, landing_path, read_landing
from strata.sources.store import HIDDEN, NULL_PARTITION, TableStore

log = logging.getLogger(__name__)

SILVER_MARKS = "silver_watermark"
GOLD_MARKS = "gold_watermark"
GOLD_CHANGES = "gold_changes"
REJECTS = "rejected_rows"
# Silver tables are partitioned by the month of ingestion.
SILVER_PARTITIONS = ["year", "month"]
# The fact is partitioned by the month of its date, a column of the store's own.
FACT_MONTH = f"{HIDDEN}month"
# Sums per month and product that the KPI tables are made from, partitioned like the fact.
KPI_PARTIALS = "kpi_partials"
# Silver tables the gold layer reads.
GOLD_INPUTS = ["orders", "order_items", "customers", "staffs", "stores", "products",
               "categories", "brands"]


@dataclass
class PipelineConfig:
    landing_dir: str
    lake_root: str
    registry: Registry = field(default_factory=load_registry)
    tables: list[str] | None = None
    as_of: dt.date | None = None
    collapse: str = "first"
    null_safe_merge: bool = True
    lookback_days: int = 7
    table_format: str = "parquet"
    multi_line_csv: bool = True

    def table_names(self) -> list[str]:
        return list(self.tables or self.registry.keys())


def bronze_schema(spec: TableSpec) -> T.StructType:
    fields = list(spec.raw_schema().fields) + [
        T.StructField(RAW_HASH, T.StringType()),
        T.StructField("_source_file", T.StringType()),
        T.StructField(INGESTION_TS, T.TimestampType()),
        T.StructField("_batch_id", T.StringType()),
        T.StructField(INGESTION_DATE, T.DateType()),
    ]
    return T.StructType(fields)


# ------------------------------------------------------------------ bronze --
def bronze_frame(raw: DataFrame, spec: TableSpec, batch_id: str) -> DataFrame:
    """Raw text rows -> row hash, quality rules, lineage columns."""
    hashed = with_raw_hash(raw, spec.column_names)
    passed = apply_quality_raw(hashed, spec)
    out = with_lineage(passed, batch_id, F.col("_source_file"))
    return out.select(*bronze_schema(spec).fieldNames())


def rejects(raw: DataFrame, spec: TableSpec, batch_id) -> DataFrame:
    """The malformed rows of ``raw`` for the log; ``batch_id``: text or a column."""
    return raw.where(F.col(CORRUPT).isNotNull()).select(
        F.lit(spec.name).alias("table_name"), F.col(CORRUPT).alias("row_text"),
        F.array(*spec.column_names).alias("fields"), "_source_file",
        F.current_timestamp().alias(INGESTION_TS), F.lit(batch_id).alias("_batch_id"))


def bronze_load(spark: SparkSession, store: TableStore, spec: TableSpec, source: str,
                batch_id: str | None = None, multi_line: bool = True) -> int:
    """Append one landing file (or folder) to the table's bronze history;
    returns the number of rows appended (observed during the write).  Rows that
    are no CSV rows of this table go to the control log ``rejected_rows``."""
    batch = batch_id or uuid.uuid4().hex
    obs, seen = Observation(f"bronze_{spec.name}"), Observation(f"landing_{spec.name}")
    raw = read_landing(spark, spec, source, multi_line)
    whole = raw.observe(seen, F.count(CORRUPT).alias("rejected")).where(F.col(CORRUPT).isNull())
    df = bronze_frame(whole, spec, batch)
    store.append("bronze", spec.name, df.observe(obs, F.count(F.lit(1)).alias("rows")),
                 partition_by=spec.partition_by)
    if seen.get["rejected"]:
        log.warning("%s: %d malformed rows", source, seen.get["rejected"])
        store.append("control", REJECTS, rejects(raw, spec, batch))
    return int(obs.get["rows"])


# ------------------------------------------------------------------ silver --
def _marks(store: TableStore, table: str, schema: T.StructType) -> DataFrame | None:
    if not store.exists("control", table):
        return None
    return store.read("control", table, schema)


def silver_watermark(store: TableStore, table: str) -> dt.datetime | None:
    control = _marks(store, SILVER_MARKS, WATERMARK_SCHEMA)
    return None if control is None else watermark_of(control, table)


def silver_load(spark: SparkSession, store: TableStore, spec: TableSpec,
                collapse: str = "first", null_safe: bool = True) -> int:
    """Merge the bronze rows newer than the table's watermark into silver.
    Returns the number of incoming rows (0: nothing to do)."""
    if not store.exists("bronze", spec.name):
        return 0
    mark = silver_watermark(store, spec.name)
    bronze = store.read("bronze", spec.name, bronze_schema(spec))
    if mark is not None:
        # partition filter: skip whole ingestion days before the mark.  One
        # day of margin: the mark arrives in the driver's local time zone,
        # which may be ahead of the session's; the exact filter follows.
        bronze = bronze.where(F.col(INGESTION_DATE) >= F.lit(mark.date() - dt.timedelta(days=1)))
    obs = Observation(f"silver_{spec.name}")
    sliced = slice_since(bronze, INGESTION_TS, mark).observe(
        obs, F.count(F.lit(1)).alias("n"), F.max(INGESTION_TS).alias("newest"))
    incoming = store.stage(silver_dataset(sliced, spec, None, collapse), f"silver-{spec.name}")
    n, newest = int(obs.get["n"]), obs.get["newest"]
    if n == 0:
        return 0
    store.upsert("silver", spec.name, incoming, spec.primary_key, hash_col="row_hash",
                 null_safe=null_safe, partition_by=SILVER_PARTITIONS)
    # the mark advances over every row read, accepted or not
    add_mark(spark, store, SILVER_MARKS, spec.name, newest)
    return n


def add_mark(spark: SparkSession, store: TableStore, log_table: str, table: str, newest: dt.datetime) -> None:
    store.append("control", log_table, spark.createDataFrame([(table, newest)], WATERMARK_SCHEMA))


# -------------------------------------------------------------------- gold --
def gold_mark(store: TableStore, table: str) -> dt.date | None:
    control = _marks(store, GOLD_MARKS, PROCESSED_SCHEMA)
    return None if control is None else watermark_of(control, table, "last_processed_date")


def set_gold_mark(spark: SparkSession, store: TableStore, table: str, value: dt.date) -> None:
    """Replace the table's processed date (delete + insert as one merge)."""
    row = spark.createDataFrame([(table, value)], PROCESSED_SCHEMA)
    store.upsert("control", GOLD_MARKS, row, ["table_name"])


def upsert_table(store: TableStore, layer: str, table: str, df: DataFrame,
                 keys: list[str]) -> int:
    """Stage ``df``; skip when empty; else create the table or merge into it
    (matched rows replaced, new rows inserted).  Returns staged rows."""
    staged = store.stage(df, f"{layer}-{table}")
    n = staged.count()
    if n:
        store.upsert(layer, table, staged, keys)
    return n


def gold_load(spark: SparkSession, store: TableStore, cfg: PipelineConfig) -> dict[str, int]:
    """Dimensions, calendar and fact.  The calendar and the fact are rebuilt for
    the orders that changed since the last load (``operators.changes``) and merged."""
    silver = {t: store.read("silver", t) for t in GOLD_INPUTS}
    out: dict[str, int] = {}
    changes = _marks(store, GOLD_CHANGES, WATERMARK_SCHEMA)
    since = None if changes is None else watermark_of(changes, "fact_sales")
    # read before anything is built: rows that arrive meanwhile are next time's
    newest = max((m for m in (silver[t].agg(F.max(INGESTION_TS)).first()[0] for t in GOLD_INPUTS) if m),
                 default=None)
    last = gold_mark(store, "fact_sales")
    if since is not None:
        silver["orders"] = store.stage(changed_orders(silver, since, last, cfg.lookback_days), "gold-orders")

    dims = gold_plan.build_dimensions(silver)
    dim_date = store.stage(dims["dim_date"], "gold-dim_date")
    out["dim_date"] = n = dim_date.count()
    if n:
        store.upsert("gold", "dim_date", dim_date, gold_plan.GOLD_KEYS["dim_date"])
        set_gold_mark(spark, store, "dim_date", dim_date.agg(F.max("full_date")).first()[0])

    for name in ("dim_customer", "dim_staff", "dim_store", "dim_product"):
        out[name] = upsert_table(store, "gold", name, dims[name], gold_plan.GOLD_KEYS[name])

    gold = {n: store.read("gold", n) for n in ("dim_date", "dim_customer", "dim_store",
                                                "dim_staff")}
    fact = gold_plan.build_fact(silver, gold, cfg.registry, as_of=cfg.as_of, month=FACT_MONTH)
    staged = store.stage(fact, "gold-fact_sales")
    out["fact_sales"] = n = staged.count()
    if n:
        store.upsert("gold", "fact_sales", staged, gold_plan.GOLD_KEYS["fact_sales"], partition_by=[FACT_MONTH],
                     dealt=True)
        date = staged.agg(key_to_date(F.max("date_key"))).first()[0]
        set_gold_mark(spark, store, "fact_sales", date if last is None else max(last, date))
    if newest is not None:
        add_mark(spark, store, GOLD_CHANGES, "fact_sales", newest)
    return out


# --------------------------------------------------------------------- KPIs --
def refresh_partials(store: TableStore) -> set[str] | None:
    """Bring ``gold.kpi_partials`` up to date with the fact: the months whose partition has
    another version than the one their partials were taken from are read again and replace
    their old rows (so rows that were replaced or moved to another month need no retraction),
    months that left the fact go.  Returns the months read; None when the fact has no month
    partitions (the KPIs then take the whole fact).

    A fact that is dropped and built anew starts its versions again: drop the partials with it."""
    now = store.partition_versions("gold", "fact_sales", [FACT_MONTH])
    if now is None:
        return None
    then: dict[str, int] = {}
    if store.exists("gold", KPI_PARTIALS):
        held = set(store.partition_versions("gold", KPI_PARTIALS, [FACT_MONTH]) or {})
        # One row per month comes to the driver.
        taken = store.read("gold", KPI_PARTIALS).select("fact_folder", "fact_version").distinct().collect()
        then = {r["fact_folder"]: r["fact_version"] for r in taken if r["fact_folder"] in held}
    changed = {p for p, v in now.items() if then.get(p) != v}
    gone = set(then) - set(now)
    if not changed and not gone:
        return set()
    fact = store.read_partitions("gold", "fact_sales", [FACT_MONTH], changed)
    stamp = store.spark.createDataFrame([(p, now[p]) for p in sorted(changed)], "fact_folder string, fact_version int")
    month = F.coalesce(F.col(FACT_MONTH).cast("string"), F.lit(NULL_PARTITION))
    rows = kpis.partials(fact, store.read("gold", "dim_date"), [FACT_MONTH]) \
        .withColumn("fact_folder", F.concat(F.lit(f"{FACT_MONTH}="), month)) \
        .join(F.broadcast(stamp), "fact_folder")
    store.replace_partitions("gold", KPI_PARTIALS, rows, [FACT_MONTH], changed | gone, dealt=True)
    return changed


def kpi_load(spark: SparkSession, store: TableStore) -> dict[str, int]:
    """Refresh every KPI table; an empty result keeps the old one.  Only the months of the
    fact that changed since the last refresh are read (``refresh_partials``); the tables
    are sums of the partials per month and product."""
    gold = {n: store.read("gold", n) for n in ("fact_sales", "dim_date", "dim_product")}
    per_product = None
    if refresh_partials(store) is None:
        # one pass over the fact for all five monthly tables
        measures = kpis.monthly_measures(gold["fact_sales"], gold["dim_date"])
    else:
        parts = store.read("gold", KPI_PARTIALS)
        measures, per_product = kpis.measures_of(parts), kpis.revenue_of(parts)
    measures = store.stage(measures, "kpi-monthly")
    out = {}
    for name, df in gold_plan.build_kpis(gold, measures, per_product).items():
        staged = store.stage(df, f"kpi-{name}")
        out[name] = n = staged.count()
        if n:
            store.write_snapshot("gold", name, staged)
            store.vacuum("gold", name)
    return out


# ----------------------------------------------------------------- driver --
def run(spark: SparkSession, cfg: PipelineConfig,
        layers: tuple[str, ...] = ("bronze", "silver", "gold", "kpi")) -> dict[str, dict]:
    """Run the chosen layers in order; returns per-table row counts."""
    store = TableStore(spark, cfg.lake_root, cfg.table_format)
    store.ensure_layers()
    report: dict[str, dict] = {}
    names = cfg.table_names()
    try:
        if "bronze" in layers:
            report["bronze"] = {}
            for t in names:
                src = landing_path(cfg.landing_dir, t)
                if not store.path_exists(src):
                    log.warning("no landing file for %s at %s; skipped", t, src)
                    report["bronze"][t] = 0
                    continue
                report["bronze"][t] = bronze_load(spark, store, cfg.registry.spec(t), src,
                                                  multi_line=cfg.multi_line_csv)
            known = {f"{t}.csv" for t in cfg.registry}
            for other in sorted(set(store.list_names(cfg.landing_dir)) - known):
                log.warning("%s/%s is no table of the registry; left alone", cfg.landing_dir, other)
        if "silver" in layers:
            report["silver"] = {t: silver_load(spark, store, cfg.registry.spec(t), cfg.collapse,
                                               cfg.null_safe_merge) for t in names}
        if "gold" in layers:
            report["gold"] = gold_load(spark, store, cfg)
        if "kpi" in layers:
            report["kpi"] = kpi_load(spark, store)
    finally:
        store.drop_staged()
    log.info("pipeline report: %s", report)
    return report
