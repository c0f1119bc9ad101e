"""Merges that rewrite only the partitions they touch."""

import random

import pytest
from pyspark.sql import functions as F

from strata.operators.merge import merge_upsert
from strata.sources import store as S
from strata.sources.store import HIDDEN, TableStore

SCHEMA = "id long, sub string, v string, h string, year int, month int"
BY = ["year", "month"]


def _frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _rows(df):
    return sorted((repr(tuple(r)) for r in df.select("id", "sub", "v", "h", "year", "month").collect()))


def _row(rng, i, months):
    v = rng.choice("abcdef")
    y = rng.choice((2023, 2024, None))
    return (i, rng.choice(("x", None)), v, f"h{v}", y, rng.randrange(1, months))


@pytest.mark.parametrize("hash_col", ["h", None])
@pytest.mark.parametrize("null_safe", [True, False])
def test_equals_the_whole_merge(spark, scratch, hash_col, null_safe):
    """Six loads: repeated and NULL keys, NULL partitions, rows that move, equal hashes."""
    rng = random.Random(len(str(hash_col)) + null_safe)
    store = TableStore(spark, scratch)
    first = _frame(spark, [_row(rng, i, 5) for i in range(60)])
    store.write_snapshot("silver", "t", first, BY)
    want = _frame(spark, [tuple(r) for r in first.collect()])
    for _ in range(6):
        ids = rng.sample(range(90), 8)
        load = _frame(spark, [_row(rng, i, 7) for i in ids])
        want = _frame(spark, [tuple(r) for r in merge_upsert(want, load, ["id", "sub"], hash_col, null_safe).collect()])
        store.upsert("silver", "t", store.stage(load), ["id", "sub"], hash_col, null_safe, BY)
        assert _rows(store.read("silver", "t")) == _rows(want)


def test_one_per_cent_writes_only_touched_partitions(spark, scratch):
    store = TableStore(spark, scratch)
    rows = [(i, "x", "a", "ha", 2020 + i // 1200, 1 + i // 100 % 12) for i in range(4800)]
    store.write_snapshot("silver", "t", _frame(spark, rows), BY)
    load = [(i, "x", "b", "hb", 2020, 1) for i in range(48)] + [(9000, "x", "n", "hn", 2030, 7)]
    store.upsert("silver", "t", store.stage(_frame(spark, load)), ["id", "sub"], "h", True, BY)
    base = store.snapshot_path("silver", "t")
    assert store._partition_folders(base, 2) == ["year=2020/month=1", "year=2030/month=7"]
    assert len(store._parts("silver", "t")[1]) == 49
    assert store.read("silver", "t").count() == 4801
    # Unchanged rows touch nothing: no new version.
    store.upsert("silver", "t", store.stage(_frame(spark, load)), ["id", "sub"], "h", True, BY)
    assert store.snapshot_path("silver", "t") == base
    # A filter on the partitions reaches every folder of the union.
    plan = store.read("silver", "t").where("year = 2023")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(year") == 2


def test_a_partition_can_empty_and_old_folders_go(spark, scratch):
    store = TableStore(spark, scratch)
    store.write_snapshot("silver", "t", _frame(spark, [(1, "x", "a", "a", 2020, 1), (2, "x", "a", "a", 2020, 2)]), BY)
    for n in range(S.MAX_LIVE + 3):
        load = _frame(spark, [(1, "x", f"v{n}", f"v{n}", 2021, n)])
        store.upsert("silver", "t", store.stage(load), ["id", "sub"], "h", True, BY)
        got = {(r["id"], r["v"], r["year"], r["month"]) for r in store.read("silver", "t").collect()}
        assert got == {(1, f"v{n}", 2021, n), (2, "a", 2020, 2)}
        assert "year=2020/month=1" not in (store._parts("silver", "t") or (None, {}))[1]
    assert len(store.versions("silver", "t")) <= 4  # two snapshots, and what they still read


def test_an_unfinished_merge_is_not_seen(spark, scratch):
    store = TableStore(spark, scratch)
    store.write_snapshot("silver", "t", _frame(spark, [(1, "x", "a", "a", 2020, 1)]), BY)
    broken = f"{store.path('silver', 't')}/v00000002"
    store._put(f"{broken}/_partial", "")
    _frame(spark, [(1, "x", "lost", "l", 2020, 1)]).write.mode("append").partitionBy(*BY).parquet(broken)
    assert store.versions("silver", "t") == [1]
    store.upsert("silver", "t", store.stage(_frame(spark, [(2, "x", "b", "b", 2020, 1)])), ["id", "sub"], "h", True, BY)
    assert sorted(r["v"] for r in store.read("silver", "t").collect()) == ["a", "b"]


def test_hidden_partition_columns_are_left_out(spark, scratch):
    store = TableStore(spark, scratch)
    df = _frame(spark, [(i, "x", "a", "a", 2020, i) for i in range(3)]).withColumn(f"{HIDDEN}m", F.col("month"))
    store.write_snapshot("gold", "t", df, [f"{HIDDEN}m"])
    store.upsert("gold", "t", store.stage(df.withColumn("h", F.lit("z")).limit(1)), ["id"], None, True, [f"{HIDDEN}m"])
    assert f"{HIDDEN}m" not in store.read("gold", "t").columns
    assert store.read("gold", "t").where("h = 'z'").count() == 1


def test_a_merge_of_all_rows_stages_keys_alone(spark, scratch, monkeypatch):
    """Rows that come without a hash all count: they are not joined again to learn so."""
    store, staged = TableStore(spark, scratch), []
    rows = [(i, "x", f"v{i}", "h", 2020 + i % 3, 1) for i in range(30)]
    store.write_snapshot("silver", "t", _frame(spark, rows), BY)
    load = _frame(spark, [(0, "x", "w", "h", 2022, 1), (90, None, "n", "h", 2021, 1)])
    load.write.parquet(f"{scratch}/load")
    load = spark.read.parquet(f"{scratch}/load")
    put = store.stage
    monkeypatch.setattr(store, "stage", lambda df, label="stage": staged.append(df.columns) or put(df, label))
    store.upsert("silver", "t", load, ["id", "sub"], partition_by=BY)
    assert staged and not [c for c in staged if "v" in c]
    want = [r for r in rows if r[0]] + [tuple(r) for r in load.collect()]
    assert _rows(store.read("silver", "t")) == _rows(_frame(spark, want))


@pytest.mark.parametrize("null_safe", [True, False])
def test_a_merge_of_all_rows_into_repeated_keys(spark, scratch, null_safe):
    """Repeated target rows of a key are each replaced, in whatever partitions they lie."""
    store = TableStore(spark, scratch)
    rows = [(1, "x", "a", "h", 2020, 1), (1, "x", "b", "h", 2021, 1), (2, None, "c", "h", 2021, 2), (3, "x", "d", "h", 2022, 1)]
    store.write_snapshot("silver", "t", _frame(spark, rows), BY)
    load = store.stage(_frame(spark, [(1, "x", "n", "h", 2022, 1), (2, None, "m", "h", 2020, 1)]))
    want = _frame(spark, [tuple(r) for r in merge_upsert(_frame(spark, rows), load, ["id", "sub"], None, null_safe).collect()])
    store.upsert("silver", "t", load, ["id", "sub"], None, null_safe, BY)
    assert _rows(store.read("silver", "t")) == _rows(want)
    with pytest.raises(ValueError, match="2 rows"):
        store.upsert("silver", "t", store.stage(load.where("id = 1").unionByName(load.where("id = 1"))), ["id", "sub"],
                     None, null_safe, BY)
