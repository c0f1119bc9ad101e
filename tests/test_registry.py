"""Registry: JSON file round trip, schemas, partition re-aim, type checks."""

import json

import pytest
from pyspark.sql import types as T

from strata.registry import DEFAULT_REGISTRY, INGESTION_DATE, load_registry


def test_json_round_trip(scratch):
    raw = json.loads(json.dumps(DEFAULT_REGISTRY))
    for entry in raw.values():
        entry["partition_by"] = ["_ingestion_timestamp"]   # as the source catalogue declares
    path = f"{scratch}/registry.json"
    with open(path, "w", encoding="utf-8") as fh:
        json.dump(raw, fh)
    reg = load_registry(path)
    assert set(reg) == set(DEFAULT_REGISTRY)
    orders = reg.spec("orders")
    assert orders.partition_by == [INGESTION_DATE]
    assert orders.primary_key == ["order_id", "customer_id", "store_id", "staff_id"]
    assert orders.typed_schema()["order_date"].dataType == T.DateType()
    assert all(f.dataType == T.StringType() for f in orders.raw_schema().fields)
    assert list(orders.derived_columns) == ["days_to_ship", "promised_days", "is_shipped",
                                            "is_late", "sla_met", "days_open", "delay_days",
                                            "open_delay_days"]
    assert reg.spec("staffs").text_columns() == ["first_name", "last_name", "phone", "email"]


def test_unknown_type_rejected(scratch):
    path = f"{scratch}/bad.json"
    with open(path, "w", encoding="utf-8") as fh:
        json.dump({"t": {"columns": {"a": "uuid"}, "primary_key": ["a"]}}, fh)
    with pytest.raises(ValueError):
        load_registry(path)
    with pytest.raises(KeyError):
        load_registry().spec("nope")
