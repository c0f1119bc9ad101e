"""Retail model tables derived from TPC-H-style parquet tables.

The mapping (one function per model table) is what stands in for the silver
layer when the library runs on the benchmark tables:

* orders      <- orders, with the ship date from lineitem
* order_items <- lineitem
* products, brands, categories <- part
* customers   <- customer x nation x region
* stores      <- supplier
* staffs      <- nation x region
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.ranking import dense_rank_values


# Order status letter -> status code of the model.
ORDER_STATUS = {"O": 1, "P": 2, "F": 4}
# Promised delivery = 30 days per priority digit; store and
# staff are assigned round-robin over 10 stores and 25 staff members.
DAYS_PER_PRIORITY = 30
N_STORES = 10
N_STAFF = 25


def _null_text():
    return F.lit(None).cast("string")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table, as many splits as its files have."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _after_hash(c: str):
    return F.split_part(F.col(c), F.lit("#"), F.lit(2))


def orders(spark: SparkSession, sf_dir: str, as_of: dt.date | None = None) -> DataFrame:
    """One row per order.  shipped_date is the last ship date of the order's
    lines when that is on/after the order date, else NULL.  The lines are
    reduced to one row per order (map-side) before the join.

    ``as_of``: the table as it stood at the end of that day (orders placed
    and lines shipped by then), e.g. the previous load of an incremental run.
    """
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    li = table(spark, sf_dir, "lineitem")
    if as_of is not None:
        # the files hold timestamp_ntz; a literal of that type keeps the
        # predicate pushable into the parquet scan
        end = F.lit(dt.datetime.combine(as_of + dt.timedelta(days=1), dt.time())) \
            .cast("timestamp_ntz")
        o = o.where(F.col("o_orderdate") < end)
        li = li.where(F.col("l_shipdate") < end)
    last_ship = li.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"))
    j = o.join(last_ship, o["o_orderkey"] == last_ship["l_orderkey"], "left")
    status = F.lit(None).cast("int")
    for letter, code in ORDER_STATUS.items():
        status = F.when(F.col("o_orderstatus") == letter, F.lit(code)).otherwise(status)
    order_date = F.col("o_orderdate").cast("date")
    prio_digit = F.substring("o_orderpriority", 1, 1).cast("int")
    return j.select(
        F.col("o_orderkey").cast("int").alias("order_id"),
        F.col("o_custkey").cast("int").alias("customer_id"),
        status.alias("order_status"),
        order_date.alias("order_date"),
        F.date_add(order_date, prio_digit * DAYS_PER_PRIORITY).alias("required_date"),
        F.when(F.col("last_ship") >= F.col("o_orderdate"), F.col("last_ship").cast("date"))
         .alias("shipped_date"),
        (F.col("o_orderkey") % N_STORES).cast("int").alias("store_id"),
        (F.col("o_orderkey") % N_STAFF).cast("int").alias("staff_id"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").cast("int").alias("order_id"),
        F.col("l_linenumber").cast("int").alias("item_id"),
        F.col("l_partkey").cast("int").alias("product_id"),
        F.round("l_quantity").cast("int").alias("quantity"),
        (F.col("l_extendedprice") / F.nullif(F.col("l_quantity"), F.lit(0.0))).alias("list_price"),
        F.col("l_discount").alias("discount"),
    )


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct part types numbered 1.. in text order (distributed dense rank)."""
    types = table(spark, sf_dir, "part").select(F.col("p_type").alias("category_name"))
    return dense_rank_values(types, "category_name", "category_id") \
        .select("category_id", "category_name")


def brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "part")
            .select(_after_hash("p_brand").cast("int").alias("brand_id"),
                    F.col("p_brand").alias("brand_name"))
            .distinct())


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    cats = categories(spark, sf_dir)
    return p.join(cats, p["p_type"] == cats["category_name"], "inner").select(
        F.col("p_partkey").cast("int").alias("product_id"),
        _after_hash("p_brand").cast("int").alias("brand_id"),
        F.col("category_id"),
        F.col("p_name").alias("product_name"),
        (F.lit(2000) + F.col("p_size")).cast("int").alias("model_year"),
        F.col("p_retailprice").alias("list_price"),
    )


def _nation_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n["n_regionkey"] == r["r_regionkey"], "inner")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    nr = _nation_region(spark, sf_dir)
    return c.join(nr, c["c_nationkey"] == nr["n_nationkey"], "inner").select(
        F.col("c_custkey").cast("int").alias("customer_id"),
        F.lit("Customer").alias("first_name"),
        _after_hash("c_name").alias("last_name"),
        _null_text().alias("phone"),
        _null_text().alias("email"),
        _null_text().alias("street"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        _null_text().alias("zip_code"),
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").cast("int").alias("store_id"),
        F.col("s_name").alias("store_name"),
        *[_null_text().alias(c) for c in ("phone", "email", "street", "city", "state", "zip_code")],
    )


def staffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    nr = _nation_region(spark, sf_dir)
    return nr.select(
        F.col("n_nationkey").cast("int").alias("staff_id"),
        F.col("n_regionkey").cast("int").alias("store_id"),
        F.when(F.col("n_nationkey") != 0, F.lit(0)).alias("manager_id"),
        F.col("n_name").alias("first_name"),
        F.col("r_name").alias("last_name"),
        _null_text().alias("phone"),
        _null_text().alias("email"),
        F.lit(1).alias("active"),
    )


def stocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units sold per store and product (the model has no stock feed)."""
    items = order_items(spark, sf_dir)
    ords = orders(spark, sf_dir).select("order_id", "store_id")
    return (items.join(ords, "order_id").groupBy("store_id", "product_id")
            .agg(F.sum("quantity").cast("int").alias("quantity")))


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text, the way a landing CSV delivers it."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


MODEL_TABLES = {
    "orders": orders, "order_items": order_items, "products": products, "brands": brands,
    "categories": categories, "customers": customers, "stores": stores, "staffs": staffs,
    "stocks": stocks,
}


class ModelTables(Mapping):
    """name -> model table; each is planned on first access only."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir, self._built = spark, sf_dir, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = MODEL_TABLES[name](self._spark, self._dir)
        return self._built[name]

    def __iter__(self):
        return iter(MODEL_TABLES)

    def __len__(self) -> int:
        return len(MODEL_TABLES)


def model_tables(spark: SparkSession, sf_dir: str) -> ModelTables:
    """Every model table, planned lazily over the parquet files."""
    return ModelTables(spark, sf_dir)
