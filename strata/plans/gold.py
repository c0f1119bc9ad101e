"""Gold layer plan: dimensions, date dimension and the sales fact from
silver-shaped tables (lazy DataFrames; nothing is materialised here)."""

from __future__ import annotations

import datetime as dt

from collections.abc import Mapping

from pyspark.sql import DataFrame

from strata.operators import dims, facts, kpis
from strata.registry import Registry, load_registry

GOLD_TABLES = ["dim_date", "dim_customer", "dim_staff", "dim_store", "dim_product", "fact_sales"]

# Merge keys of each gold table.
GOLD_KEYS = {
    "dim_date": ["date_key"],
    "dim_customer": ["customer_id"],
    "dim_staff": ["staff_id"],
    "dim_store": ["store_id"],
    "dim_product": ["product_id"],
    "fact_sales": facts.FACT_GRAIN,
}


def build_dimension(name: str, silver: Mapping[str, DataFrame],
                    last_date: dt.date | None = None) -> DataFrame:
    if name == "dim_date":
        return dims.dim_date(silver["orders"], last_date)
    if name == "dim_customer":
        return dims.dim_customer(silver["customers"])
    if name == "dim_staff":
        return dims.dim_staff(silver["staffs"])
    if name == "dim_store":
        return dims.dim_store(silver["stores"])
    if name == "dim_product":
        return dims.dim_product(silver["products"], silver["categories"], silver["brands"])
    raise KeyError(name)


class _Lazy(Mapping):
    """name -> frame, planned on first access."""

    def __init__(self, names, build):
        self._names, self._build, self._done = list(names), build, {}

    def __getitem__(self, name):
        if name not in self._done:
            if name not in self._names:
                raise KeyError(name)
            self._done[name] = self._build(name)
        return self._done[name]

    def __setitem__(self, name, df):
        if name not in self._names:
            self._names.append(name)
        self._done[name] = df

    def __iter__(self):
        return iter(self._names)

    def __len__(self):
        return len(self._names)


DIMENSIONS = ["dim_date", "dim_customer", "dim_staff", "dim_store", "dim_product"]


def build_dimensions(silver: Mapping[str, DataFrame], last_date: dt.date | None = None
                     ) -> _Lazy:
    """Every dimension (each planned when first used)."""
    return _Lazy(DIMENSIONS, lambda n: build_dimension(n, silver, last_date))


def build_fact(silver: dict[str, DataFrame], gold: dict[str, DataFrame],
               registry: Registry | None = None, last_date: dt.date | None = None,
               as_of: dt.date | None = None, month: str | None = None) -> DataFrame:
    return facts.fact_sales(silver["order_items"], silver["orders"], gold["dim_date"],
                            gold["dim_customer"], gold["dim_store"], gold["dim_staff"],
                            registry or load_registry(), last_processed=last_date, as_of=as_of, month=month)


def build_gold(silver: dict[str, DataFrame], registry: Registry | None = None,
               as_of: dt.date | None = None) -> dict[str, DataFrame]:
    """Full (non-incremental) gold build; tables are planned when first used."""
    def build(name: str) -> DataFrame:
        if name == "fact_sales":
            return build_fact(silver, gold, registry, None, as_of)
        return build_dimension(name, silver)
    gold = _Lazy([*DIMENSIONS, "fact_sales"], build)
    return gold


def build_kpis(gold: Mapping[str, DataFrame], measures: DataFrame | None = None,
               per_product: DataFrame | None = None) -> _Lazy:
    """Every KPI table by name, planned when first used.  The monthly tables
    are projections of one monthly aggregate (``measures``; pass a staged
    copy to compute it once for all five); ``per_product``: revenue per product."""
    shared: dict[str, DataFrame] = {}

    def monthly() -> DataFrame:
        if "m" not in shared:
            shared["m"] = measures if measures is not None else \
                kpis.monthly_measures(gold["fact_sales"], gold["dim_date"])
        return shared["m"]

    def build(name: str) -> DataFrame:
        if name == "agg_top_products":
            if per_product is not None:
                return kpis.top_products_from(per_product, gold["dim_product"])
            return kpis.top_products(gold["fact_sales"], gold["dim_product"])
        return kpis.FROM_MEASURES[name](monthly())
    return _Lazy(kpis.KPI_ORDER, build)
