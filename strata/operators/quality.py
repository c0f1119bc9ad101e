"""Registry data-quality rules (``column -> SQL predicate suffix``).

All rules of a table are AND-ed.  A rule that evaluates to NULL (a NULL in
the ruled column) drops the row, exactly like a SQL WHERE clause.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.casts import typed_cast
from strata.registry import TableSpec


def rule_condition(rules: dict[str, str], ref: dict[str, str] | None = None) -> Column | None:
    """AND of ``<column> <rule>``; ``ref`` maps a column to the name to test."""
    ref = ref or {}
    conds = [F.expr(f"`{ref.get(c, c)}` {rule}") for c, rule in rules.items()]
    if not conds:
        return None
    return reduce(lambda a, b: a & b, conds)


def apply_quality(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Keep the rows that pass every rule (rules read the columns as they are)."""
    cond = rule_condition(rules)
    return df if cond is None else df.where(cond)


def apply_quality_raw(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Quality rules on raw text rows: each ruled column is tested on its
    typed value (a value that does not parse is NULL), the text is kept."""
    rules = spec.data_quality
    if not rules:
        return df
    fields = {f.name: f.dataType for f in df.schema.fields}
    tmp = {c: f"__dq_{c}" for c in rules}
    out = df.withColumns({tmp[c]: typed_cast(c, spec.columns[c], fields.get(c)) for c in rules})
    return out.where(rule_condition(rules, tmp)).drop(*tmp.values())
