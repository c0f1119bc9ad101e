"""availableNow stream: each landing file is loaded once; changes merge."""

import pytest
from pyspark.sql import functions as F

from strata.plans.silver import silver_columns
from strata.registry import load_registry
from strata.sources import tpch
from strata.sources.store import TableStore
from strata.streaming import landing_stream, stream_tables
from strata.streaming.ledger import LEDGER
from tests.conftest import SF_SMALL

REG = load_registry()


def test_stream_loads_new_files_once(spark, scratch):
    landing, lake, ckpt = f"{scratch}/landing", f"{scratch}/lake", f"{scratch}/ckpt"
    orders = tpch.orders(spark, SF_SMALL)
    early = orders.where(F.col("order_date") < F.lit("1998-01-01").cast("date"))
    late = orders.where(F.col("order_date") >= F.lit("1998-01-01").cast("date"))
    early.coalesce(1).write.option("header", True).csv(f"{landing}/orders/part1")
    stream_tables(spark, landing, lake, tables=["orders"], checkpoint_root=ckpt)
    store = TableStore(spark, lake)
    assert store.read("silver", "orders").count() == early.count()

    late.coalesce(1).write.option("header", True).csv(f"{landing}/orders/part2")
    # the same orders again with a new status: updates, not inserts
    changed = early.withColumn("order_status", F.lit(4))
    changed.coalesce(1).write.option("header", True).csv(f"{landing}/orders/part3")
    stream_tables(spark, landing, lake, tables=["orders"], checkpoint_root=ckpt)

    silver = store.read("silver", "orders")
    assert silver.columns == silver_columns(REG.spec("orders"))
    assert silver.count() == orders.count()
    assert silver.where(F.col("order_status") == 4).count() == \
        changed.count() + late.where(F.col("order_status") == 4).count()
    # every file read once: bronze holds each landing row exactly once
    assert store.read("bronze", "orders").count() == early.count() + late.count() + changed.count()


def _parts(spark, landing):
    orders = tpch.orders(spark, SF_SMALL)
    orders.where("order_id % 2 = 0").coalesce(1).write.option("header", True).csv(f"{landing}/orders/part1")
    yield orders.where("order_id % 2 = 0").count()
    orders.where("order_id % 2 = 1").coalesce(1).write.option("header", True).csv(f"{landing}/orders/part2")
    yield orders.count()


def test_replay_under_a_new_checkpoint_reads_no_bronze_and_adds_nothing(spark, scratch, monkeypatch):
    landing, lake = f"{scratch}/landing", f"{scratch}/lake"
    parts = _parts(spark, landing)
    half = next(parts)
    stream_tables(spark, landing, lake, tables=["orders"], checkpoint_root=f"{scratch}/one")
    store = TableStore(spark, lake)
    assert store.read("bronze", "orders").count() == half

    every = next(parts)
    plain, seen = TableStore.read, []

    def read(self, layer, table, *args, **kw):
        seen.append((layer, table))
        return plain(self, layer, table, *args, **kw)

    with monkeypatch.context() as m:
        m.setattr(TableStore, "read", read)
        m.setattr(landing_stream, "silver_load", lambda *a: 0)
        stream_tables(spark, landing, lake, tables=["orders"], checkpoint_root=f"{scratch}/two")
    assert set(seen) == {("control", f"{LEDGER}/orders")}
    assert store.read("bronze", "orders").count() == every


@pytest.mark.parametrize("dies", ["before the bronze append", "after it"])
def test_run_that_dies_around_the_append_is_completed_once(spark, scratch, monkeypatch, dies):
    landing, lake, ckpt = f"{scratch}/landing", f"{scratch}/lake", f"{scratch}/ckpt"
    parts = _parts(spark, landing)
    next(parts)
    stream_tables(spark, landing, lake, tables=["orders"], checkpoint_root=ckpt)
    every = next(parts)
    plain = TableStore.append

    def append(self, layer, table, *args, **kw):
        if layer == "bronze":
            if dies == "after it":
                plain(self, layer, table, *args, **kw)
            raise RuntimeError("lost")
        return plain(self, layer, table, *args, **kw)

    with monkeypatch.context() as m:
        m.setattr(TableStore, "append", append)
        with pytest.raises(Exception, match="lost"):
            stream_tables(spark, landing, lake, tables=["orders"], checkpoint_root=ckpt)
    for _ in range(2):
        stream_tables(spark, landing, lake, tables=["orders"], checkpoint_root=ckpt)
    store = TableStore(spark, lake)
    assert store.read("bronze", "orders").count() == every
    assert store.read("silver", "orders").count() == every


def test_lake_without_a_ledger_gets_one_from_its_bronze(spark, scratch, monkeypatch):
    landing, lake = f"{scratch}/landing", f"{scratch}/lake"
    half = next(_parts(spark, landing))
    with monkeypatch.context() as m:
        m.setattr("strata.streaming.ledger._log", lambda spec: f"{LEDGER}/elsewhere")
        stream_tables(spark, landing, lake, tables=["orders"], checkpoint_root=f"{scratch}/one")
    stream_tables(spark, landing, lake, tables=["orders"], checkpoint_root=f"{scratch}/two")
    assert TableStore(spark, lake).read("bronze", "orders").count() == half
