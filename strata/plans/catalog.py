"""Registered queries over the benchmark tables (TPC-H style parquet).

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame built with
the library's operators on the whole tables.  Sums of doubles are rounded in
the output (money to cents, ratios to 10 places) so that results compare
across engines whose summation order differs.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import dates
from strata.functions.hashing import raw_row_hash, row_hash
from strata.functions.text import clean_text as clean_text_col
from strata.operators import kpis
from strata.operators.changes import changed_orders
from strata.operators.dedup import latest_by_key
from strata.operators.derived import with_derived
from strata.operators.merge import merge_upsert
from strata.operators.projection import INGESTION_TS, typed_projection, with_calendar_split
from strata.operators.quality import apply_quality, apply_quality_raw
from strata.operators.ranking import global_rank
from strata.operators.watermark import slice_since, watermarks_per_table
from strata.plans import gold as gold_plan
from strata.plans import silver as silver_plan
from strata.plans.pipeline import FACT_MONTH, KPI_PARTIALS, refresh_partials
from strata.registry import TableSpec, load_registry
from strata.session import ensure_checkpoint_dir
from strata.sources import tpch
from strata.sources.store import HIDDEN, TableStore

# Fixed "today" for the open-order columns so results are reproducible.
AS_OF = dt.date(2002, 1, 1)
# Incremental scenarios: the previous load of orders stood at the end of
# ORDERS_CUTOFF and the new load re-reads orders placed in the last
# RELOAD_DAYS before it; event loads are split at EVENTS_CUTOFF.
ORDERS_CUTOFF = dt.date(1998, 1, 1)
RELOAD_DAYS = 90
EVENTS_CUTOFF = dt.datetime(2024, 1, 15)
# Last processed date for the look-back scenarios.
LAST_PROCESSED = dt.date(2001, 6, 1)
# Watermarks of the incremental silver and changed-order scenarios.
SILVER_MARK = dt.datetime(1998, 6, 1, tzinfo=dt.timezone.utc)
CHANGES_SINCE = dt.datetime(2001, 1, 1, tzinfo=dt.timezone.utc)
CHANGES_LAST = LAST_PROCESSED
NULL_SPELLINGS = ["", " N/A ", "na", "NULL", "-"]

Query = Callable[[SparkSession, str], DataFrame]


def _rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.withColumns({c: F.round(c, d) for c, d in digits.items()})


def _gold(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return gold_plan.build_gold(tpch.model_tables(spark, sf_dir), as_of=AS_OF)


def _dim(name: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return gold_plan.build_dimension(name, tpch.model_tables(spark, sf_dir))
    q.__name__ = name
    return q


def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir)["fact_sales"]


def _monthly(fn, digits: dict[str, int]) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        g = _gold(spark, sf_dir)
        return _rounded(fn(g["fact_sales"], g["dim_date"]), digits)
    q.__name__ = fn.__name__
    return q


def agg_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _gold(spark, sf_dir)
    return _rounded(kpis.top_products(g["fact_sales"], g["dim_product"]),
                    {"total_revenue": 2, "revenue_share": 10})


def _refreshed_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The KPI partials after two loads of a month-partitioned fact: orders before the cut-off,
    then the rest with a reload of the last RELOAD_DAYS before it.  The second refresh reads
    only the months that the second load wrote."""
    silver = tpch.model_tables(spark, sf_dir)
    g = gold_plan.build_dimensions(silver)
    store = TableStore(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/strata-kpi-{uuid.uuid4().hex}")
    store.write_snapshot("gold", "dim_date", g["dim_date"])
    fact = store.stage(gold_plan.build_fact(silver, g, as_of=AS_OF, month=FACT_MONTH), "fact")
    cut = int(ORDERS_CUTOFF.strftime("%Y%m%d"))
    reload = int((ORDERS_CUTOFF - dt.timedelta(RELOAD_DAYS)).strftime("%Y%m%d"))
    for load in (fact.where(F.col("date_key") < cut), fact.where(F.col("date_key") >= reload)):
        store.upsert("gold", "fact_sales", load, gold_plan.GOLD_KEYS["fact_sales"], partition_by=[FACT_MONTH],
                     dealt=True)
        refresh_partials(store)
    out = store.read("gold", KPI_PARTIALS)
    store.drop_staged()
    return out


def agg_monthly_billing_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _refreshed_partials(spark, sf_dir)
    return _rounded(kpis.billing_from(kpis.measures_of(parts)), {"total_billing": 2})


REG = load_registry()
ORDER_KEYS = REG.spec("orders").primary_key


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tpch.table(spark, sf_dir, "events")


# ---------------------------------------------------------------- rows ----
def dq_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order_items quality rules, discount tightened to 0..0.05 so rows fail."""
    rules = dict(REG.spec("order_items").data_quality, discount="BETWEEN 0 AND 0.05")
    return apply_quality(tpch.order_items(spark, sf_dir), rules)


def dq_filter_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rules on landing text: each ruled column is tested typed."""
    spec = REG.spec("order_items")
    spec = TableSpec(spec.name, spec.columns, spec.primary_key, spec.partition_by,
                     dict(spec.data_quality, discount="BETWEEN 0 AND 0.05"))
    return apply_quality_raw(tpch.as_text(tpch.order_items(spark, sf_dir)), spec)


def raw_row_hash_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = tpch.table(spark, sf_dir, "customer")
    return c.select("c_custkey", raw_row_hash(c.columns).alias("_row_hash"))


def silver_row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = tpch.orders(spark, sf_dir)
    return o.select(*ORDER_KEYS, row_hash(REG.spec("orders").column_names).alias("row_hash"))


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = tpch.table(spark, sf_dir, "documents")
    return d.select("doc_id", clean_text_col("text").alias("clean_text"))


def clean_text_all_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = tpch.table(spark, sf_dir, "conversations")
    return d.select("conv_id", "turn", clean_text_col("text", collapse="all").alias("clean_text"))


EVENTS_SPEC = TableSpec(
    name="events",
    columns={"event_id": "integer", "user_id": "integer", "event_type": "varchar",
             "value": "integer", "props": "varchar", "ts": "timestamp"},
    primary_key=["event_id"])


def typed_projection_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as landing text -> registry types; value text rounds to int."""
    raw = tpch.as_text(_events(spark, sf_dir).select(*EVENTS_SPEC.column_names))
    return typed_projection(raw, EVENTS_SPEC)


def typed_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order_items as landing text ('23.0' quantities) -> registry types."""
    raw = tpch.as_text(tpch.order_items(spark, sf_dir))
    return typed_projection(raw, REG.spec("order_items"))


def partition_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir).select("event_id", "ts")
    return with_calendar_split(e, "ts").select("event_id", "year", "month")


def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest line per (l_orderkey, l_linenumber) by ship date."""
    li = tpch.table(spark, sf_dir, "lineitem")
    return latest_by_key(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def _event_loads(spark: SparkSession, sf_dir: str):
    e = _events(spark, sf_dir)
    first = e.where(F.col("ts") <= F.lit(EVENTS_CUTOFF).cast("timestamp_ntz"))
    second = e.where(F.col("ts") > F.lit(EVENTS_CUTOFF).cast("timestamp_ntz"))
    return e, first, second


def watermark_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append-only control rows (one per loaded event) -> newest per table."""
    control = _events(spark, sf_dir).select(F.col("event_type").alias("table_name"),
                                            F.col("ts").alias("last_watermark"))
    return watermarks_per_table(control)


def incremental_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks recorded by the first load (per event type); the slice of the
    whole table strictly after its type's mark."""
    e, first, _ = _event_loads(spark, sf_dir)
    marks = watermarks_per_table(first.select(F.col("event_type").alias("table_name"),
                                              F.col("ts").alias("last_watermark")))
    j = e.join(marks, e["event_type"] == marks["table_name"], "left")
    return j.where(F.col("last_watermark").isNull() | (F.col("ts") > F.col("last_watermark"))) \
        .select(*e.columns)


def incremental_slice_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slice_since(_events(spark, sf_dir), "ts", EVENTS_CUTOFF)


def _hashed_orders(df: DataFrame) -> DataFrame:
    return df.withColumn("row_hash", row_hash(REG.spec("orders").column_names))


def merge_conditional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver orders as of the cut-off, merged with a reload of the recent
    orders: changed rows (new ship date) updated, new orders inserted,
    unchanged and older rows kept."""
    target = _hashed_orders(tpch.orders(spark, sf_dir, as_of=ORDERS_CUTOFF))
    source = _hashed_orders(tpch.orders(spark, sf_dir).where(
        F.col("order_date") >= F.date_sub(F.lit(ORDERS_CUTOFF), RELOAD_DAYS)))
    return merge_upsert(target, source, ORDER_KEYS, hash_col="row_hash")


def _order_loads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(silver orders as of the cut-off, reload of the recent orders), hashed."""
    return (_hashed_orders(tpch.orders(spark, sf_dir, as_of=ORDERS_CUTOFF)),
            _hashed_orders(tpch.orders(spark, sf_dir).where(
                F.col("order_date") >= F.date_sub(F.lit(ORDERS_CUTOFF), RELOAD_DAYS))))


def merge_touched_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through the table store: orders partitioned by the month of their date,
    the reload merged by rewriting the touched months alone."""
    month = F.date_format("order_date", "yyyyMM").cast("int")
    target, source = (df.withColumn(f"{HIDDEN}month", month) for df in _order_loads(spark, sf_dir))
    store = TableStore(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/strata-merge-{uuid.uuid4().hex}")
    store.write_snapshot("silver", "orders", target, [f"{HIDDEN}month"])
    store.upsert("silver", "orders", store.stage(source, "reload"), ORDER_KEYS, hash_col="row_hash",
                 partition_by=[f"{HIDDEN}month"])
    out = store.read("silver", "orders")
    store.drop_staged()
    return out


def _shipment_merge(spark: SparkSession, sf_dir: str, null_safe: bool) -> DataFrame:
    """Orders keyed by (order, ship date): the ship date of an open order is NULL."""
    target, source = _order_loads(spark, sf_dir)
    return merge_upsert(target, source, [*ORDER_KEYS, "shipped_date"], hash_col="row_hash", null_safe=null_safe)


def merge_null_keys_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain '=': open orders match nothing and are inserted again."""
    return _shipment_merge(spark, sf_dir, null_safe=False)


def merge_null_safe_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shipment_merge(spark, sf_dir, null_safe=True)


def merge_unconditional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest event per user from the first load, upserted with the latest
    per user from the second load (SCD type 1)."""
    _, first, second = _event_loads(spark, sf_dir)
    cols = ["user_id", "ts", "event_id", "event_type", "value"]
    t = latest_by_key(first.select(*cols), ["user_id"], ["ts"])
    s = latest_by_key(second.select(*cols), ["user_id"], ["ts"])
    return merge_upsert(t, s, ["user_id"])


def _staff_merge(spark: SparkSession, sf_dir: str, null_safe: bool) -> DataFrame:
    spec = REG.spec("staffs")
    raw = tpch.staffs(spark, sf_dir)
    target = raw.withColumn("row_hash", row_hash(spec.column_names))
    cleaned = typed_projection(raw, spec).withColumn("row_hash", row_hash(spec.column_names))
    return merge_upsert(target, cleaned, spec.primary_key, hash_col="row_hash",
                        null_safe=null_safe)


def merge_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key with a NULL (manager_id), plain '=': the NULL-key row is inserted again."""
    return _staff_merge(spark, sf_dir, null_safe=False)


def merge_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staff_merge(spark, sf_dir, null_safe=True)


def orders_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_derived(tpch.orders(spark, sf_dir), REG.spec("orders"), as_of=AS_OF)


def items_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_derived(tpch.order_items(spark, sf_dir), REG.spec("order_items"))


def fact_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = tpch.model_tables(spark, sf_dir)
    g = gold_plan.build_dimensions(silver)
    return gold_plan.build_fact(silver, g, REG, last_date=LAST_PROCESSED, as_of=AS_OF)


def dim_date_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = tpch.model_tables(spark, sf_dir)
    return gold_plan.build_dimensions(silver, last_date=LAST_PROCESSED)["dim_date"]


def _bronze_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped order_items: text, ingestion time = ship time, real duplicate keys."""
    li = tpch.table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").cast("string").alias("item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_quantity").cast("string").alias("quantity"),
        F.col("l_extendedprice").cast("string").alias("list_price"),
        F.col("l_discount").cast("string").alias("discount"),
        F.col("l_shipdate").cast("timestamp").alias("_ingestion_timestamp"))


def silver_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze order_items -> silver rows: latest per key, typed, hashed,
    quality-filtered."""
    out = silver_plan.silver_dataset(_bronze_items(spark, sf_dir), REG.spec("order_items"), watermark=None)
    return out.drop("row_hash")


def silver_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a watermark on, with the row hash."""
    return silver_plan.silver_dataset(_bronze_items(spark, sf_dir), REG.spec("order_items"),
                                      watermark=SILVER_MARK)


def clean_null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text, five in eight replaced by a spelling of "no value"."""
    d = tpch.table(spark, sf_dir, "documents")
    text = F.when(F.col("doc_id") % 8 < len(NULL_SPELLINGS), F.try_element_at(
        F.array(*[F.lit(t) for t in NULL_SPELLINGS]), (F.col("doc_id") % 8 + 1).cast("int"))).otherwise(F.col("text"))
    return d.withColumn("t", text).select("doc_id", clean_text_col("t").alias("clean_text"))


def clean_null_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's whole text cleaned, and whether it is a spelling of "no value";
    so are its lines, which hold such spellings beside words."""
    d = tpch.table(spark, sf_dir, "documents")
    lines = F.transform(F.split("text", "\n"), lambda x: clean_text_col(x))
    return d.select("doc_id", clean_text_col("text").alias("clean_text"),
                    F.size(F.filter(lines, lambda x: x.isNull())).cast("long").alias("null_lines"))


def rank_with_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All order lines by quantity: fifty values, each shared by many lines."""
    li = tpch.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return global_rank(li, "l_quantity", "quantity_rank")


def gold_changed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders to rebuild when orders arrived at their ship (else order) date, items at
    theirs, and customers day by day."""
    orders = tpch.orders(spark, sf_dir)
    early = F.lit("1990-01-01").cast("timestamp")
    silver = {
        "orders": orders.withColumn(INGESTION_TS, F.coalesce("shipped_date", "order_date").cast("timestamp")),
        "order_items": tpch.table(spark, sf_dir, "lineitem").select(
            F.col("l_orderkey").cast("int").alias("order_id"), F.col("l_shipdate").cast("timestamp").alias(INGESTION_TS)),
        "customers": tpch.customers(spark, sf_dir).withColumn(
            INGESTION_TS, F.date_add(F.lit("1997-01-01").cast("date"), F.col("customer_id")).cast("timestamp")),
        "stores": tpch.stores(spark, sf_dir).withColumn(INGESTION_TS, early),
        "staffs": tpch.staffs(spark, sf_dir).withColumn(INGESTION_TS, early),
    }
    return changed_orders(silver, CHANGES_SINCE, CHANGES_LAST).drop(INGESTION_TS)


QUERIES: dict[str, Query] = {
    "dq_filter": dq_filter,
    "dq_filter_raw": dq_filter_raw,
    "raw_row_hash": raw_row_hash_q,
    "silver_row_hash": silver_row_hash,
    "clean_text": clean_text,
    "clean_text_all_runs": clean_text_all_runs,
    "typed_projection": typed_projection_q,
    "typed_order_items": typed_order_items,
    "partition_columns": partition_columns,
    "dedup_latest": dedup_latest,
    "watermark_max": watermark_max,
    "incremental_slice": incremental_slice,
    "incremental_slice_literal": incremental_slice_literal,
    "merge_conditional": merge_conditional,
    "merge_touched_partitions": merge_touched_partitions,
    "merge_null_keys_orders": merge_null_keys_orders,
    "merge_null_safe_orders": merge_null_safe_orders,
    "merge_unconditional": merge_unconditional,
    "merge_null_keys": merge_null_keys,
    "merge_null_safe": merge_null_safe,
    "orders_derived": orders_derived,
    "items_derived": items_derived,
    "silver_transform": silver_transform,
    "silver_incremental": silver_incremental,
    "clean_null_tokens": clean_null_tokens,
    "clean_null_spellings": clean_null_spellings,
    "rank_with_ties": rank_with_ties,
    "gold_changed_orders": gold_changed_orders,
    "dim_date_lookback": dim_date_lookback,
    "fact_lookback": fact_lookback,
    "dim_date": _dim("dim_date"),
    "dim_customer": _dim("dim_customer"),
    "dim_staff": _dim("dim_staff"),
    "dim_store": _dim("dim_store"),
    "dim_product": _dim("dim_product"),
    "fact_sales": fact_sales,
    "agg_monthly_billing": _monthly(kpis.monthly_billing, {"total_billing": 2}),
    "agg_sla": _monthly(kpis.sla, {}),
    "agg_delay": _monthly(kpis.delay, {}),
    "agg_top_products": agg_top_products,
    "agg_monthly_billing_refreshed": agg_monthly_billing_refreshed,
    "agg_monthly_average_ticket": _monthly(kpis.average_ticket,
                                           {"total_revenue": 2, "avg_ticket": 6}),
    "agg_monthly_discount": _monthly(kpis.discount, {"total_gross": 2,
                                                     "total_discount_value": 4,
                                                     "discount_rate": 10}),
}
