"""A third of all order lines in one order: the fact join must split it.

Broadcasts are disabled so the order lines meet the orders in a shuffle
join; AQE's skew thresholds are lowered to this data size.  The plan must
show a skew-split join and the result must equal the unsplit plan's.
"""

import datetime as dt

from pyspark.sql import functions as F

from strata.plans import gold as gold_plan
from strata.sources import tpch
# AQE splits a skewed partition along map outputs, so the hot partition must
# come from several map tasks.
SF_SKEW = "/root/testdata/sf0.1"

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _skewed_gold(spark):
    silver = dict(tpch.model_tables(spark, SF_SKEW))
    items = silver["order_items"]
    hot = F.col("item_id") % 3 == 0          # every third line moves to order 0
    # the file is one row group; a large table is read by many tasks
    silver["order_items"] = items.repartition(8).withColumn(
        "order_id", F.when(hot, F.lit(0)).otherwise(F.col("order_id")))
    return gold_plan.build_gold(silver, as_of=dt.date(2002, 1, 1))["fact_sales"]


def _plan_and_rows(spark, conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = _skewed_gold(spark)
        rows = sorted((tuple(r) for r in df.collect()), key=str)
        plan = df._jdf.queryExecution().executedPlan().toString()
        return plan, rows
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_order_is_split_and_result_unchanged(spark):
    plan, rows = _plan_and_rows(spark, SKEW_CONF)
    assert "skew=true" in plan
    off = dict(SKEW_CONF, **{"spark.sql.adaptive.skewJoin.enabled": "false"})
    plan_off, rows_off = _plan_and_rows(spark, off)
    assert "skew=true" not in plan_off
    assert rows == rows_off
