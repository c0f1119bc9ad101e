"""Gold dimensions (SCD type 1): one row per natural key, ``*_key`` = id."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import dates
from strata.operators.dedup import first_by_key
from strata.operators.watermark import lookback

# The attribute list of each dimension, in output order.
CUSTOMER_COLUMNS = ["customer_id", "first_name", "last_name", "email", "city", "state"]
STAFF_COLUMNS = ["staff_id", "store_id", "first_name", "last_name", "active"]
STORE_COLUMNS = ["store_id", "store_name"]
PRODUCT_COLUMNS = ["product_id", "product_name", "model_year", "list_price",
                   "category_id", "category_name", "brand_id", "brand_name"]
DATE_COLUMNS = ["full_date", "date_key", "year", "month", "day", "quarter", "day_of_week",
                "is_weekend", "month_name", "day_name", "week_of_year", "is_month_start",
                "is_month_end"]


def keyed_dimension(df: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """DISTINCT attributes, one row per ``{name}_id`` (deterministic pick),
    plus the surrogate ``{name}_key`` equal to the id."""
    nid = f"{name}_id"
    one = first_by_key(df.select(*columns), [nid])
    return one.withColumn(f"{name}_key", F.col(nid))


def dim_customer(customers: DataFrame) -> DataFrame:
    return keyed_dimension(customers, "customer", CUSTOMER_COLUMNS)


def dim_staff(staffs: DataFrame) -> DataFrame:
    return keyed_dimension(staffs, "staff", STAFF_COLUMNS)


def dim_store(stores: DataFrame) -> DataFrame:
    return keyed_dimension(stores, "store", STORE_COLUMNS)


def dim_product(products: DataFrame, categories: DataFrame, brands: DataFrame) -> DataFrame:
    """products inner-joined to their category, left-joined to their brand."""
    cats = categories.select("category_id", "category_name").where(F.col("category_id").isNotNull())
    brs = brands.select("brand_id", "brand_name")
    p = products.select("product_id", "product_name", "model_year", "list_price",
                        "category_id", "brand_id")
    joined = p.join(cats, "category_id", "inner").join(brs, "brand_id", "left")
    return keyed_dimension(joined, "product", PRODUCT_COLUMNS)


def dim_date(orders: DataFrame, last_processed: dt.date | None = None,
             lookback_days: int = 7) -> DataFrame:
    """One row per distinct order date after ``last_processed - lookback``,
    with calendar attributes (Monday = 0, ISO week)."""
    d = lookback(orders.select(F.col("order_date").alias("full_date")), "full_date",
                 last_processed, lookback_days, inclusive=False)
    d = d.where(F.col("full_date").isNotNull()).distinct()
    fd = F.col("full_date")
    return d.select(
        fd.alias("full_date"),
        dates.date_key(fd).alias("date_key"),
        F.year(fd).alias("year"),
        F.month(fd).alias("month"),
        F.dayofmonth(fd).alias("day"),
        F.quarter(fd).alias("quarter"),
        dates.day_of_week(fd).alias("day_of_week"),
        dates.is_weekend(fd).alias("is_weekend"),
        dates.month_name(fd).alias("month_name"),
        dates.day_name(fd).alias("day_name"),
        dates.week_of_year(fd).alias("week_of_year"),
        dates.is_month_start(fd).alias("is_month_start"),
        dates.is_month_end(fd).alias("is_month_end"),
    )
