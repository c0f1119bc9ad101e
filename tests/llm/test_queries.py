"""Registered operator queries: oracles, names, and native plans."""

import pytest

import __spark_entry__ as E
from strata.llm.oracles import ORACLE
from strata.llm.queries import QUERIES
from tests.conftest import SF_ORACLE
from tools.oracle_check import duck, value_hash


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_oracle(spark, name):
    df = QUERIES[name](spark, SF_ORACLE)
    rows = [tuple(r) for r in df.collect()]
    res = duck(SF_ORACLE).execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert value_hash(df.columns, rows) == value_hash(cols, res.fetchall())


def test_one_query_per_operator():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(E.queries())


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if n.split("_")[0] in ("op3", "op7", "op10")])
def test_native_plans_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF_ORACLE)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
