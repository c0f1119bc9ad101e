"""KPIs refreshed from the months that changed equal a refresh of the whole fact."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from strata.operators import kpis
from strata.plans import gold as gold_plan
from strata.plans.pipeline import FACT_MONTH, KPI_PARTIALS, kpi_load, refresh_partials
from strata.sources import store as S
from strata.sources import tpch
from strata.sources.store import TableStore

FACT = ("order_id int, item_id int, product_id int, date_key int, quantity int, gross_amount double, "
        "discount double, is_shipped int, is_late int, sla_met int, delay_days int")
KEYS = ["order_id", "item_id"]


def _line(rng, i, months=8):
    shipped = rng.choice((0, 1, 1, None))
    late = rng.choice((0, 1, None))
    key = rng.choice((20240000 + 100 * rng.randrange(1, months) + rng.randrange(1, 28), 20240399, None))
    return (i, 1, rng.randrange(6), key, rng.choice((1, 2, None)), rng.randrange(400) / 4, rng.randrange(4) / 16,
            shipped, late, None if late is None else 1 - late, rng.choice((None, -2, 0, 5)))


def _load(spark, store, rows):
    df = spark.createDataFrame(rows, FACT).withColumn(FACT_MONTH, F.floor(F.col("date_key") / 100).cast("int"))
    store.upsert("gold", "fact_sales", store.stage(df), KEYS, partition_by=[FACT_MONTH])


@pytest.fixture
def store(spark, scratch):
    out = TableStore(spark, scratch)
    days = [dt.date(2024, 1, 1) + dt.timedelta(n) for n in range(366)]
    out.write_snapshot("gold", "dim_date", spark.createDataFrame(
        [(d, int(d.strftime("%Y%m%d"))) for d in days], "full_date date, date_key int"))
    out.write_snapshot("gold", "dim_product", spark.createDataFrame(
        [(i, f"p{i}") for i in range(5)], "product_id int, product_name string"))
    return out


def _rows(df):
    digits = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    return sorted(repr(tuple(r)) for r in df.select(*digits).collect())


def _same(store):
    whole = {n: store.read("gold", n) for n in ("fact_sales", "dim_date", "dim_product")}
    for name, want in gold_plan.build_kpis(whole).items():
        assert _rows(store.read("gold", name)) == _rows(want), name


def test_many_loads_equal_one_full_refresh(spark, store, monkeypatch):
    """New lines, replaced ones, lines that move to another month, no day, no calendar day; the
    table is rewritten whole in between."""
    monkeypatch.setattr(S, "MAX_LIVE", 2)
    rng = random.Random(7)
    _load(spark, store, [_line(rng, i, 4) for i in range(60)])
    refresh_partials(store)
    for _ in range(3):
        _load(spark, store, [_line(rng, i, 5) for i in rng.sample(range(80), 4)])
        refresh_partials(store)
    kpi_load(spark, store)
    _same(store)


def test_only_changed_months_are_read(spark, store):
    line = lambda i, month, p=1: (i, 1, p, 20240001 + 100 * month, 1, 2.0, 0.25, 1, 0, 1, 0)
    _load(spark, store, [line(i, 1 + i % 12) for i in range(24)])
    assert len(refresh_partials(store)) == 12
    assert refresh_partials(store) == set()
    # line 0 (month 1) moves to month 3; month 5 gains a line
    _load(spark, store, [line(0, 3), line(100, 5, 2)])
    read = refresh_partials(store)
    assert read == {f"{FACT_MONTH}={202400 + m}" for m in (1, 3, 5)}
    files = store.read_partitions("gold", "fact_sales", [FACT_MONTH], read).inputFiles()
    assert files and {f.split("/")[-2] for f in files} == read


def test_a_month_that_leaves_the_fact(spark, store):
    line = lambda i, month: (i, 1, 1, 20240001 + 100 * month, 1, 2.0, 0.25, 1, 0, 1, 0)
    _load(spark, store, [line(1, 1), line(2, 2)])
    kpi_load(spark, store)
    _load(spark, store, [line(1, 3)])  # month 1 is empty now
    kpi_load(spark, store)
    _same(store)
    months = {str(r["month"])[:7] for r in store.read("gold", KPI_PARTIALS).select("month").collect()}
    assert months == {"2024-02", "2024-03"}


def test_a_fact_without_partitions_is_read_whole(spark, store):
    rng = random.Random(3)
    store.write_snapshot("gold", "fact_sales", spark.createDataFrame([_line(rng, i) for i in range(30)], FACT))
    assert refresh_partials(store) is None
    kpi_load(spark, store)
    assert not store.exists("gold", KPI_PARTIALS)
    assert set(kpis.KPI_ORDER) <= set(store.list_names(store.path("gold", "")))


def _exchanges(df):
    """(arguments, input columns) of every shuffle of the plan."""
    text = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    found = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: (.*)", text)
    return [(args, {c.split("#")[0] for c in cols.split(", ")}) for cols, args in found]


def test_partials_shuffle_slim_lines_once(spark, store):
    _load(spark, store, [_line(random.Random(5), i) for i in range(20)])
    fact = store.read_partitions("gold", "fact_sales", [FACT_MONTH],
                                 set(store.partition_versions("gold", "fact_sales", [FACT_MONTH])))
    found = _exchanges(kpis.partials(fact, store.read("gold", "dim_date"), [FACT_MONTH]))
    assert len(found) == 1 and "rangepartitioning" in found[0][0]


def test_lines_are_not_shuffled_by_customer_nor_with_computed_amounts(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    silver = tpch.model_tables(spark, "/root/testdata/sf0.001")
    gold = gold_plan.build_gold(silver, as_of=dt.date(2001, 1, 1))
    fact = gold_plan.build_fact(silver, gold, as_of=dt.date(2001, 1, 1), month=FACT_MONTH)
    found = _exchanges(fact)
    assert any("customer_id" in args for args, _ in found)
    assert not [args for args, cols in found if "customer" in args and "quantity" in cols]
    assert not [cols for _, cols in found if {"gross_amount", "net_amount", "total_item_amount"} & cols]
    # the same rows, and the month
    assert _rows(fact.drop(FACT_MONTH)) == _rows(gold["fact_sales"])
    assert fact.where(f"{FACT_MONTH} <> date_key div 100").isEmpty()
