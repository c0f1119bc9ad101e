"""Which orders an incremental gold load must rebuild."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.projection import INGESTION_TS
from strata.operators.watermark import LOOKBACK_DAYS, lookback, slice_since

# The order column that names each dimension's row.
DIMENSION_OF = {"customers": "customer_id", "stores": "store_id", "staffs": "staff_id"}


def changed_orders(silver: Mapping[str, DataFrame], since: dt.datetime | None, last_date: dt.date | None = None,
                   lookback_days: int = LOOKBACK_DAYS, ts_col: str = INGESTION_TS) -> DataFrame:
    """The orders whose fact rows may differ from the last load's: they, one of their
    items, their customer, store or staff arrived or changed after ``since``; or they
    are open (their status depends on the day); or their date lies in the look-back
    before ``last_date``.  All orders when ``since`` is None.

    A silver row keeps its ingestion time until its content changes, so only changed
    keys take part in the joins.
    """
    orders = silver["orders"]
    if since is None:
        return orders
    keys = ["order_id", "customer_id", "store_id", "staff_id"]
    picked = [slice_since(orders, ts_col, since), orders.where(F.col("shipped_date").isNull())]
    if last_date is not None:
        picked.append(lookback(orders, "order_date", last_date, lookback_days, inclusive=True))
    changed_items = slice_since(silver["order_items"], ts_col, since).select("order_id").distinct()
    picked.append(orders.join(changed_items, "order_id", "left_semi"))
    for table, key in DIMENSION_OF.items():
        picked.append(orders.join(slice_since(silver[table], ts_col, since).select(key).distinct(), key, "left_semi"))
    wanted = reduce(DataFrame.unionByName, [p.select(*keys) for p in picked]).distinct()
    on = reduce(lambda a, b: a & b, [orders[k].eqNullSafe(F.col(f"_{k}")) for k in keys])
    return orders.join(wanted.select(*[F.col(k).alias(f"_{k}") for k in keys]), on, "left_semi")
