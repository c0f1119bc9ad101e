"""Plan checks: the physical plans are the ones intended for scale."""

import datetime as dt

import pytest

import __spark_entry__ as E
from strata.operators.watermark import slice_since
from strata.plans.catalog import QUERIES
from strata.plans.pipeline import bronze_schema
from strata.registry import load_registry
from strata.sources.store import TableStore
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udfs(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas",
                 "MapInPandas"):
        assert node not in plan, f"{name} runs Python: {node}"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_round_robin(spark, name):
    assert "RoundRobin" not in _plan(E.queries()[name](spark, SF_SMALL))


def test_rank_has_no_global_window(spark):
    plan = _plan(E.queries()["agg_top_products"](spark, SF_SMALL))
    assert "rank(" not in plan.lower().replace("revenue_rank", "")


def test_slice_filter_reaches_scan(spark):
    df = E.queries()["incremental_slice_literal"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in plan


def test_bronze_slice_prunes_partitions(spark, scratch):
    spec = load_registry().spec("brands")
    store = TableStore(spark, f"{scratch}/lake")
    rows = [("1", "a", "h", "f", dt.datetime(2024, 1, d), "b", dt.date(2024, 1, d)) for d in (1, 2, 3)]
    store.append("bronze", "brands", spark.createDataFrame(rows, bronze_schema(spec)),
                 partition_by=spec.partition_by)
    from pyspark.sql import functions as F
    mark = dt.datetime(2024, 1, 2)
    b = store.read("bronze", "brands", bronze_schema(spec)).where(
        F.col("_ingestion_date") >= F.lit(mark.date()))
    df = slice_since(b, "_ingestion_timestamp", mark)
    plan = _plan(df)
    assert "PartitionFilters: [isnotnull(_ingestion_date" in plan
    assert df.count() == 1
