"""Every registered query equals its DuckDB oracle (rows, columns, values)."""

import pytest

import __spark_entry__ as E
from strata.plans.catalog import QUERIES
from tests.conftest import SF_ORACLE
from tools.oracle_check import duck, value_hash

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_ORACLE)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert len(rows) == len(drows)
    assert sorted(df.columns) == sorted(dcols)
    assert value_hash(df.columns, rows) == value_hash(dcols, drows)


_CANON = {"IntegerType": "INTEGER", "LongType": "BIGINT", "DoubleType": "DOUBLE",
          "StringType": "VARCHAR", "DateType": "DATE", "TimestampType": "TIMESTAMP",
          "TimestampNTZType": "TIMESTAMP", "BooleanType": "BOOLEAN"}


@pytest.mark.parametrize("name", NAMES)
def test_query_types_match_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_ORACLE)
    ours = {f.name: _CANON.get(type(f.dataType).__name__, str(f.dataType)) for f in df.schema.fields}
    rel = con.sql(E.oracle_sql()[name])
    theirs = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert ours == theirs


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["year_month", "total_billing", "total_orders"]
    assert df.count() > 0
