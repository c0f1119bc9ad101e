"""End to end: landing CSV -> bronze -> silver -> gold -> KPIs on files.

Checks: counts per layer, gold/KPIs equal to the same operators applied to
the cleaned model tables in memory, run-twice == run-once, and two
incremental loads == one full load.
"""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators.dedup import latest_by_key
from strata.operators.projection import typed_projection
from strata.plans import gold as gold_plan
from strata.plans.pipeline import PipelineConfig, run
from strata.registry import load_registry
from strata.sources import tpch
from strata.sources.store import TableStore
from tests.conftest import SF_SMALL

AS_OF = dt.date(2002, 1, 1)
REG = load_registry()


def _write_landing(spark, frames, landing):
    for name, df in frames.items():
        df.coalesce(1).write.option("header", True).csv(f"{landing}/{name}.csv")


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _approx_rows(df):
    """Rows with doubles as pytest.approx: sums of doubles depend on the
    order the partitions are added in."""
    def norm(r):
        return tuple(pytest.approx(v, rel=1e-9) if isinstance(v, float) else v for v in r)
    rows = [tuple(r) for r in df.collect()]
    key = [i for i, f in enumerate(df.schema.fields)
           if type(f.dataType).__name__ != "DoubleType"]
    rows.sort(key=lambda r: str([r[i] for i in key]))
    return [norm(r) for r in rows]


def _expected_silver(spark):
    model = tpch.model_tables(spark, SF_SMALL)
    return {t: latest_by_key(typed_projection(tpch.as_text(df), REG.spec(t)),
                             REG.spec(t).primary_key, [])
            for t, df in model.items()}


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("pipeline")
    landing, root = f"{base}/landing", f"{base}/lake"
    _write_landing(spark, tpch.model_tables(spark, SF_SMALL), landing)
    cfg = PipelineConfig(landing_dir=landing, lake_root=root, as_of=AS_OF)
    first = run(spark, cfg)
    return cfg, first, TableStore(spark, root)


def test_layer_counts(spark, lake):
    cfg, report, store = lake
    model = tpch.model_tables(spark, SF_SMALL)
    for t, df in model.items():
        assert report["bronze"][t] == df.count(), t
        assert report["silver"][t] == df.count(), t
        pk = REG.spec(t).primary_key
        assert store.read("silver", t).count() == df.select(*pk).distinct().count(), t
    assert set(report["kpi"]) == set(gold_plan.build_kpis(
        {n: store.read("gold", n) for n in ("fact_sales", "dim_date", "dim_product")}))


def test_gold_and_kpis_equal_in_memory_plan(spark, lake):
    cfg, report, store = lake
    expected = gold_plan.build_gold(_expected_silver(spark), as_of=AS_OF)
    for name in gold_plan.GOLD_TABLES:
        got = store.read("gold", name)
        assert _rows(got.select(*expected[name].columns)) == _rows(expected[name]), name
    kpis = gold_plan.build_kpis(expected)
    for name, df in kpis.items():
        assert _approx_rows(df) == [tuple(r) for r in sorted(
            (tuple(r) for r in store.read("gold", name).collect()),
            key=lambda r: str([v for v in r if not isinstance(v, float)]))], name


def test_run_twice_equals_run_once(spark, lake):
    cfg, report, store = lake
    before = {n: _rows(store.read("gold", n)) for n in ["fact_sales", "dim_date", "agg_sla"]}
    silver_before = _rows(store.read("silver", "orders").drop("_ingestion_timestamp", "year", "month"))
    run(spark, cfg)                      # the same landing files again (full re-append)
    assert _rows(store.read("silver", "orders").drop(
        "_ingestion_timestamp", "year", "month")) == silver_before
    for n, rows in before.items():
        assert _rows(store.read("gold", n)) == rows, n
    assert store.read("bronze", "orders").count() == 2 * tpch.orders(spark, SF_SMALL).count()


def test_incremental_equals_full(spark, lake, scratch):
    cfg, report, store = lake
    model = tpch.model_tables(spark, SF_SMALL)
    cut = dt.date(1998, 6, 1)
    early = dict(model, orders=model["orders"].where(F.col("order_date") < F.lit(cut)))
    late = {"orders": model["orders"].where(F.col("order_date") >= F.lit(cut))}
    root = f"{scratch}/lake"
    _write_landing(spark, early, f"{scratch}/l1")
    _write_landing(spark, late, f"{scratch}/l2")
    run(spark, PipelineConfig(landing_dir=f"{scratch}/l1", lake_root=root, as_of=AS_OF))
    run(spark, PipelineConfig(landing_dir=f"{scratch}/l2", lake_root=root, as_of=AS_OF,
                              tables=["orders"]))
    inc = TableStore(spark, root)
    cols = REG.spec("orders").column_names
    assert _rows(inc.read("silver", "orders").select(*cols)) == \
        _rows(store.read("silver", "orders").select(*cols))
    assert _rows(inc.read("gold", "fact_sales")) == _rows(store.read("gold", "fact_sales"))
    for n in ("agg_monthly_billing", "agg_top_products"):
        got = sorted((tuple(r) for r in inc.read("gold", n).collect()),
                     key=lambda r: str([v for v in r if not isinstance(v, float)]))
        assert _approx_rows(store.read("gold", n)) == got, n


def test_second_silver_run_without_new_bronze_does_nothing(spark, scratch):
    landing = f"{scratch}/landing"
    tpch.brands(spark, SF_SMALL).coalesce(1).write.option("header", True).csv(f"{landing}/brands.csv")
    cfg = PipelineConfig(landing_dir=landing, lake_root=f"{scratch}/lake", tables=["brands"])
    run(spark, cfg, layers=("bronze", "silver"))
    store = TableStore(spark, cfg.lake_root)
    assert store.exists("control", "silver_watermark")
    before = store.versions("silver", "brands")
    assert run(spark, cfg, layers=("silver",))["silver"] == {"brands": 0}
    assert store.versions("silver", "brands") == before
    # a new day's file is all that the next load reads
    spark.createDataFrame([(99, "New")], "brand_id int, brand_name string").coalesce(1) \
        .write.mode("overwrite").option("header", True).csv(f"{landing}/brands.csv")
    assert run(spark, cfg, layers=("bronze", "silver"))["silver"] == {"brands": 1}
    assert len(store.versions("silver", "brands")) <= 2
    silver = store.read("silver", "brands")
    plan = silver.where("year = 2001")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert len(silver.inputFiles()) == 1  # small partitions are written as one file
    with pytest.raises(ValueError):
        store.append("silver", "brands", store.read("silver", "brands"))


def test_late_updates_reach_the_fact(spark, scratch):
    """Loads with old orders shipped late, changed items and a renamed customer end
    where one full load of the final tables ends."""
    model = {t: df.cache() for t, df in tpch.model_tables(spark, SF_SMALL).items()}
    orders, items, people = model["orders"], model["order_items"], model["customers"]
    old = F.col("order_id") % 7 == 0
    shipped = F.date_add("order_date", 19)
    final = dict(
        model,
        orders=orders.withColumn("shipped_date", F.when(old, shipped).otherwise(F.col("shipped_date"))),
        order_items=items.withColumn("quantity", F.when(F.col("order_id") % 11 == 0, F.col("quantity") + 1)
                                     .otherwise(F.col("quantity"))),
        customers=people.withColumn("last_name", F.when(F.col("customer_id") % 13 == 0, F.lit("renamed"))
                                    .otherwise(F.col("last_name"))))
    start = dict(model, orders=orders.withColumn("shipped_date", F.when(~old, F.col("shipped_date"))))
    loads = [start,
             {"orders": final["orders"].where(old)},
             {"order_items": final["order_items"].where("order_id % 11 = 0"),
              "customers": final["customers"].where("customer_id % 13 = 0")}]
    for i, frames in enumerate(loads):
        _write_landing(spark, frames, f"{scratch}/l{i}")
        run(spark, PipelineConfig(landing_dir=f"{scratch}/l{i}", lake_root=f"{scratch}/inc", as_of=AS_OF,
                                  tables=list(frames)))
    _write_landing(spark, final, f"{scratch}/all")
    run(spark, PipelineConfig(landing_dir=f"{scratch}/all", lake_root=f"{scratch}/full", as_of=AS_OF))
    inc, full = TableStore(spark, f"{scratch}/inc"), TableStore(spark, f"{scratch}/full")
    assert _rows(inc.read("gold", "fact_sales")) == _rows(full.read("gold", "fact_sales"))
    for n in gold_plan.kpis.KPI_ORDER:
        got = sorted((tuple(r) for r in inc.read("gold", n).collect()),
                     key=lambda r: str([v for v in r if not isinstance(v, float)]))
        assert _approx_rows(full.read("gold", n)) == got, n


def test_missing_landing_file_is_skipped(spark, scratch):
    landing = f"{scratch}/landing"
    tpch.brands(spark, SF_SMALL).coalesce(1).write.option("header", True).csv(f"{landing}/brands.csv")
    report = run(spark, PipelineConfig(landing_dir=landing, lake_root=f"{scratch}/lake",
                                       tables=["brands", "categories"]),
                 layers=("bronze", "silver"))
    assert report["bronze"]["categories"] == 0 and report["silver"]["categories"] == 0
    assert report["silver"]["brands"] == tpch.brands(spark, SF_SMALL).count()
    store = TableStore(spark, f"{scratch}/lake")
    view = store.register("silver", "brands")
    assert spark.table(view).count() == report["silver"]["brands"]


def test_command_line_runs_layers(spark, scratch):
    from strata.__main__ import main
    landing = f"{scratch}/landing"
    tpch.brands(spark, SF_SMALL).coalesce(1).write.option("header", True).csv(f"{landing}/brands.csv")
    report = main(["--landing", landing, "--lake", f"{scratch}/lake", "--layers", "bronze,silver",
                   "--tables", "brands"])
    assert report["silver"]["brands"] == tpch.brands(spark, SF_SMALL).count()
