"""Gold fact: sales at order-line grain with SLA columns."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.dedup import first_by_key
from strata.operators.derived import with_derived
from strata.operators.watermark import lookback
from strata.registry import Registry, TableSpec, load_registry

# The grain of fact_sales (one row kept per combination).
FACT_GRAIN = ["order_id", "product_id", "customer_key", "store_key"]

MEASURES = ["quantity", "unit_price", "total_item_amount", "discount", "gross_amount",
            "net_amount"]


def _derivable(df: DataFrame, spec: TableSpec) -> bool:
    """Whether the columns of ``df`` are all that the derived columns need."""
    try:
        return bool(with_derived(df, spec).columns)
    except AnalysisException:
        return False


def fact_sales(order_items: DataFrame, orders: DataFrame, dim_date: DataFrame,
               dim_customer: DataFrame, dim_store: DataFrame, dim_staff: DataFrame,
               registry: Registry | None = None, last_processed: dt.date | None = None,
               lookback_days: int = 7, as_of: dt.date | None = None,
               month: str | None = None) -> DataFrame:
    """order_items x orders, with date, customer (both required), store and
    staff (optional) attributes; registry derived columns of both tables;
    orders restricted to ``order_date >= last_processed - lookback``.

    ``month``: name of a further column, the yyyyMM of the date; the rows then
    come dealt by it, and what can be computed from others is not shuffled."""
    reg = registry or load_registry()
    ords = lookback(orders, "order_date", last_processed, lookback_days, inclusive=True)
    ords = with_derived(ords, reg.spec("orders"), as_of=as_of)
    derived = list(reg.spec("orders").derived_columns)

    o = ords.select(F.col("order_id").alias("o_order_id"), "order_date", "customer_id",
                    "store_id", "staff_id", *derived)
    # One row per grain before any dimension is joined: the rows come from the
    # order join already partitioned by order, so nothing wide is shuffled.  A
    # row's date must be in the calendar and its customer known (inner joins),
    # which only drops whole (order, customer) groups, so it commutes with the
    # winner.  The lines' derived columns are computed beyond the shuffles, at
    # the end where they need no column but those of the fact.
    sold = order_items.join(o, order_items["order_id"] == o["o_order_id"], "inner")
    base = ["order_id", "product_id", "quantity", "list_price", "discount"]
    late = _derivable(order_items.select(*base), reg.spec("order_items"))
    amounts = [] if late else ["gross_amount", "net_amount"]
    lines = first_by_key((sold if late else with_derived(sold, reg.spec("order_items")))
                         .select(*base, *amounts, "order_date", "customer_id", "store_id", "staff_id", *derived),
                         ["order_id", "product_id", "customer_id", "store_id"],
                         ["order_date", "staff_id"])
    # Calendar days: bounded by the number of distinct dates.
    d = F.broadcast(dim_date.select(F.col("full_date"), F.col("date_key")))
    c = dim_customer.select(
        "customer_key", F.col("first_name").alias("c_first"), F.col("last_name").alias("c_last"))
    s = dim_store.select("store_key", "store_name")
    st = dim_staff.select(
        "staff_key", F.col("first_name").alias("s_first"), F.col("last_name").alias("s_last"))
    # Customers meet the orders, not the lines: one slim row per order is
    # shuffled by customer.  The lines stay where the order join put them, so
    # the customer's equality is no join key.
    known = (o.select("o_order_id", F.col("customer_id").alias("o_customer_id")).distinct()
             .join(c, F.col("o_customer_id") == F.col("customer_key"), "inner"))
    same_customer = F.array_contains(F.array("o_customer_id"), F.col("customer_id"))
    j = (lines.join(d, F.col("order_date") == F.col("full_date"), "inner")
         .join(known, (F.col("order_id") == F.col("o_order_id")) & same_customer, "inner")
         .join(s, F.col("store_id") == F.col("store_key"), "left")
         .join(st, F.col("staff_id") == F.col("staff_key"), "left"))
    j = j.select(
        *base, *amounts, "order_date", "date_key", "customer_key",
        F.concat(F.col("c_first"), F.lit(" "), F.col("c_last")).alias("customer_name"),
        "store_key", "store_name", "staff_key",
        F.concat(F.col("s_first"), F.lit(" "), F.col("s_last")).alias("staff_name"), *derived)
    if month is not None:
        j = j.withColumn(month, F.floor(F.col("date_key") / 100).cast("int")).hint("rebalance", month)
    if late:
        j = with_derived(j, reg.spec("order_items"))
    return j.select(
        "order_id", "order_date", "product_id", "date_key",
        F.col("customer_key").cast("string").alias("customer_key"), "customer_name",
        F.col("store_key").cast("string").alias("store_key"), "store_name", "staff_key", "staff_name",
        "quantity",
        F.col("list_price").alias("unit_price"),
        (F.col("quantity") * F.col("list_price")).alias("total_item_amount"),
        "discount", "gross_amount", "net_amount", *derived, *([month] if month is not None else []),
    )
