"""Landing CSV scan: text schema from the registry, header checked."""

import pytest

from strata.registry import load_registry
from strata.sources.landing import read_landing

SPEC = load_registry().spec("brands")


def _write(path, text):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_reads_text_and_file_name(spark, scratch):
    _write(f"{scratch}/brands.csv", "brand_id,brand_name\n1,Acme\n2,NULL\n3,\n")
    # text stays text: 'NULL' is kept, an empty field is NULL
    assert _read(spark, scratch) == [("1", "Acme", "brands.csv", None), ("2", "NULL", "brands.csv", None),
                                     ("3", None, "brands.csv", None)]


def _read(spark, scratch, name="brands.csv", **options):
    df = read_landing(spark, SPEC, f"{scratch}/{name}", **options).drop("_source_path")
    return sorted(tuple(r) for r in df.collect())


def test_quoted_text_round_trips(spark, scratch):
    _write(f"{scratch}/brands.csv", 'brand_id,brand_name\n1,"a, b"\n2,"He said ""hi"", ok"\n3,"two\nlines"\n4,x\n')
    assert [r[:2] for r in _read(spark, scratch)] == [
        ("1", "a, b"), ("2", 'He said "hi", ok'), ("3", "two\nlines"), ("4", "x")]


def test_columns_come_by_name_and_extra_ones_are_ignored(spark, scratch):
    _write(f"{scratch}/brands.csv", "brand_name,extra,brand_id\nAcme,9,1\n")
    assert _read(spark, scratch) == [("1", "Acme", "brands.csv", None)]


def test_missing_column_and_differing_headers_fail(spark, scratch):
    _write(f"{scratch}/brands.csv", "brand_id,name\n1,Acme\n")
    with pytest.raises(ValueError, match="brand_name"):
        read_landing(spark, SPEC, f"{scratch}/brands.csv")
    import os
    os.mkdir(f"{scratch}/two")
    _write(f"{scratch}/two/a.csv", "brand_id,brand_name\n1,Acme\n")
    _write(f"{scratch}/two/b.csv", "brand_name,brand_id\nAcme,1\n")
    with pytest.raises(Exception):
        read_landing(spark, SPEC, f"{scratch}/two").collect()


def test_malformed_rows_are_logged_and_counted(spark, scratch):
    from strata.plans.pipeline import REJECTS, bronze_load
    from strata.sources.store import TableStore
    _write(f"{scratch}/brands.csv", "brand_id,brand_name\n1,Acme\n2\n3,Bolt,too,many\n4,Cord\n")
    store = TableStore(spark, f"{scratch}/lake")
    assert bronze_load(spark, store, SPEC, f"{scratch}/brands.csv") == 2
    assert sorted(r["row_text"] for r in store.read("control", REJECTS).collect()) == ["2", "3,Bolt,too,many"]
