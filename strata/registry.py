"""Declarative table registry: one entry per source table.

Each entry names the columns and their types, the primary key, the bronze
partitioning, the data-quality rules (column -> SQL predicate suffix) and the
optional derived columns (name -> Spark SQL expression).  Derived columns may
read ``_as_of``: the as-of date column that stands in for "today" so results
are reproducible (see ``operators.derived``).
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import types as T

# Registry type name -> Spark type.
TYPE_MAP = {
    "integer": T.IntegerType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "varchar": T.StringType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
}


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: dict[str, str]
    primary_key: list[str]
    partition_by: list[str] = field(default_factory=list)
    data_quality: dict[str, str] = field(default_factory=dict)
    derived_columns: dict[str, str] = field(default_factory=dict)

    @property
    def column_names(self) -> list[str]:
        return list(self.columns)

    def spark_type(self, column: str) -> T.DataType:
        return TYPE_MAP[self.columns[column].lower()]

    def raw_schema(self) -> T.StructType:
        """All-string schema of the landing CSV (no type sniffing)."""
        return T.StructType([T.StructField(c, T.StringType(), True) for c in self.columns])

    def typed_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, self.spark_type(c), True) for c in self.columns])

    def text_columns(self) -> list[str]:
        return [c for c, t in self.columns.items() if t.lower() in ("varchar", "string")]


# The table catalogue of the modelled retail source.  Column
# names and types, primary keys and quality rules must equal the reference
# model; partition_by is re-aimed from the full-precision ingestion timestamp
# to the ingestion date (one partition per day instead of one per load).
DEFAULT_REGISTRY: dict[str, dict] = {
    "brands": {
        "columns": {"brand_id": "integer", "brand_name": "varchar"},
        "primary_key": ["brand_id"],
        "data_quality": {"brand_id": "IS NOT NULL"},
    },
    "categories": {
        "columns": {"category_id": "integer", "category_name": "varchar"},
        "primary_key": ["category_id"],
        "data_quality": {"category_id": "IS NOT NULL"},
    },
    "customers": {
        "columns": {
            "customer_id": "integer", "first_name": "varchar", "last_name": "varchar",
            "phone": "varchar", "email": "varchar", "street": "varchar", "city": "varchar",
            "state": "varchar", "zip_code": "varchar",
        },
        "primary_key": ["customer_id"],
        "data_quality": {"customer_id": "IS NOT NULL"},
    },
    "orders": {
        "columns": {
            "order_id": "integer", "customer_id": "integer", "order_status": "integer",
            "order_date": "date", "required_date": "date", "shipped_date": "date",
            "store_id": "integer", "staff_id": "integer",
        },
        "primary_key": ["order_id", "customer_id", "store_id", "staff_id"],
        "data_quality": {
            "order_status": "BETWEEN 0 AND 10",
            "order_date": "IS NOT NULL",
            "required_date": "IS NOT NULL",
            "order_id": "IS NOT NULL",
            "customer_id": "IS NOT NULL",
            "store_id": "IS NOT NULL",
            "staff_id": "IS NOT NULL",
        },
        "derived_columns": {
            "days_to_ship": "datediff(shipped_date, order_date)",
            "promised_days": "datediff(required_date, order_date)",
            "is_shipped": "CASE WHEN shipped_date IS NOT NULL THEN 1 ELSE 0 END",
            "is_late": "CASE WHEN shipped_date > required_date THEN 1 ELSE 0 END",
            "sla_met": "CASE WHEN shipped_date <= required_date THEN 1 ELSE 0 END",
            "days_open": "datediff(coalesce(shipped_date, _as_of), order_date)",
            "delay_days": "CASE WHEN shipped_date IS NOT NULL THEN datediff(shipped_date, required_date) END",
            "open_delay_days": "CASE WHEN shipped_date IS NULL THEN datediff(_as_of, required_date) ELSE 0 END",
        },
    },
    "order_items": {
        "columns": {
            "order_id": "integer", "item_id": "integer", "product_id": "integer",
            "quantity": "integer", "list_price": "double", "discount": "double",
        },
        "primary_key": ["order_id", "item_id", "product_id"],
        "data_quality": {
            "quantity": "> 0",
            "list_price": ">= 0",
            "discount": "BETWEEN 0 AND 1",
            "order_id": "IS NOT NULL",
            "item_id": "IS NOT NULL",
            "product_id": "IS NOT NULL",
        },
        "derived_columns": {
            "gross_amount": "quantity * list_price",
            "net_amount": "quantity * list_price * (1 - discount)",
        },
    },
    "products": {
        "columns": {
            "product_id": "integer", "brand_id": "integer", "category_id": "integer",
            "product_name": "varchar", "model_year": "integer", "list_price": "double",
        },
        "primary_key": ["product_id", "brand_id", "category_id"],
        "data_quality": {
            "list_price": ">= 0",
            "product_id": "IS NOT NULL",
            "brand_id": "IS NOT NULL",
            "category_id": "IS NOT NULL",
        },
    },
    "staffs": {
        "columns": {
            "staff_id": "integer", "store_id": "integer", "manager_id": "integer",
            "first_name": "varchar", "last_name": "varchar", "phone": "varchar",
            "email": "varchar", "active": "integer",
        },
        "primary_key": ["staff_id", "store_id", "manager_id"],
        "data_quality": {"staff_id": "IS NOT NULL", "store_id": "IS NOT NULL"},
    },
    "stocks": {
        "columns": {"store_id": "integer", "product_id": "integer", "quantity": "integer"},
        "primary_key": ["store_id", "product_id"],
        "data_quality": {
            "quantity": ">= 0",
            "store_id": "IS NOT NULL",
            "product_id": "IS NOT NULL",
        },
    },
    "stores": {
        "columns": {
            "store_id": "integer", "store_name": "varchar", "phone": "varchar",
            "email": "varchar", "street": "varchar", "city": "varchar", "state": "varchar",
            "zip_code": "varchar",
        },
        "primary_key": ["store_id"],
        "data_quality": {"store_id": "IS NOT NULL"},
    },
}

# Bronze partition column, derived from the ingestion timestamp.
INGESTION_DATE = "_ingestion_date"


class Registry(dict):
    """name -> TableSpec."""

    def spec(self, name: str) -> TableSpec:
        if name not in self:
            raise KeyError(f"table not in registry: {name}")
        return self[name]


def from_dict(raw: dict[str, dict]) -> Registry:
    reg = Registry()
    for name, entry in raw.items():
        unknown = {c: t for c, t in entry["columns"].items() if t.lower() not in TYPE_MAP}
        if unknown:
            raise ValueError(f"{name}: unsupported column types {unknown}")
        reg[name] = TableSpec(
            name=name,
            columns=dict(entry["columns"]),
            primary_key=list(entry["primary_key"]),
            partition_by=_partition_columns(entry.get("partition_by")),
            data_quality=dict(entry.get("data_quality") or {}),
            derived_columns=dict(entry.get("derived_columns") or {}),
        )
    return reg


def _partition_columns(declared: list[str] | None) -> list[str]:
    # A full-precision ingestion timestamp makes one partition per load and
    # reads back as a string; partition by its date instead.
    cols = [INGESTION_DATE if c == "_ingestion_timestamp" else c for c in (declared or [])]
    return list(dict.fromkeys(cols)) or [INGESTION_DATE]


def load_registry(path: str | Path | None = None) -> Registry:
    """Load a registry from a JSON file, or the built-in catalogue."""
    if path is None:
        return from_dict(DEFAULT_REGISTRY)
    with open(path, encoding="utf-8") as fh:
        return from_dict(json.load(fh))
