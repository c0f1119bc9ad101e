"""KPI tables reconcile with the fact they summarise."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.plans import gold as gold_plan
from strata.plans.catalog import QUERIES
from strata.sources import tpch
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def gold(spark):
    return gold_plan.build_gold(tpch.model_tables(spark, SF_SMALL), as_of=dt.date(2002, 1, 1))


def test_kpis_reconcile_with_fact(gold):
    k = gold_plan.build_kpis(gold)
    shipped = gold["fact_sales"].where("is_shipped = 1").agg(
        F.count(F.lit(1)).alias("n"), F.sum("gross_amount").alias("g"),
        F.sum("quantity").alias("q"), F.sum(F.col("discount") * F.col("gross_amount")).alias("d"),
        F.sum("is_late").alias("late"), F.sum("sla_met").alias("met")).first()
    bill = k["agg_monthly_billing"].agg(F.sum("total_billing"), F.sum("total_orders")).first()
    assert bill[0] == pytest.approx(shipped["g"], rel=1e-12) and bill[1] == shipped["n"]
    sla = k["agg_sla"].agg(F.sum("orders_on_time")).first()[0]
    late = k["agg_delay"].agg(F.sum("total_late_orders")).first()[0]
    assert (sla, late) == (shipped["met"], shipped["late"])
    disc = k["agg_monthly_discount"].agg(F.sum("total_discount_value")).first()[0]
    assert disc == pytest.approx(shipped["d"], rel=1e-12)
    top = k["agg_top_products"]
    t = top.agg(F.sum("total_revenue"), F.sum("total_quantity"), F.sum("revenue_share"),
                F.min("revenue_rank"), F.count(F.lit(1))).first()
    assert t[0] == pytest.approx(shipped["g"], rel=1e-12) and t[1] == shipped["q"]
    assert t[2] == pytest.approx(1.0, rel=1e-12) and t[3] == 1
    rows = sorted(top.select("total_revenue", "revenue_rank").collect(), key=lambda r: -r[0])
    assert all(a["revenue_rank"] <= b["revenue_rank"] for a, b in zip(rows, rows[1:]))


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith("agg_")))
def test_kpis_come_in_order(spark, name):
    rows = QUERIES[name](spark, SF_SMALL).collect()
    key = [-r["total_revenue"] if name == "agg_top_products" else r["year_month"] for r in rows]
    assert key == sorted(key) and len(rows) > 10
