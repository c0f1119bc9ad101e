"""Upsert (MERGE) as one DataFrame plan.

``merge_upsert(target, source, keys)`` returns the merged table:

* a target row with a matching source row is replaced by it - always, or only
  when the row hashes differ;
* a target row without a match is kept;
* a source row without a match is inserted.

The target is left-joined to the source (Spark broadcasts a small source, so a
large target is only streamed, or shuffles both on the keys), and the source's
new rows come from an anti join against the target's keys alone.  The meaning
does not depend on which physical join Spark picks.

A key may occur once in the source (``require_unique`` checks it, and the table
store calls it before a merge): with two source rows for one target row there
is no right winner.  Repeated target rows of a key are each updated.

``null_safe=True`` matches NULL keys to each other (``<=>``); ``False`` is plain
``=``: a NULL key never matches, so such source rows are inserted again on
every merge.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S, _HIT = "__s_", "__s_present"


def _key_condition(keys: list[str], null_safe: bool) -> Column:
    conds = [F.col(k).eqNullSafe(F.col(_S + k)) if null_safe else F.col(k) == F.col(_S + k) for k in keys]
    return reduce(lambda a, b: a & b, conds)


def hashable(kind: T.DataType) -> bool:
    """Whether equal values of the type always have equal hashes (not so for
    text under a collation)."""
    return kind == T.StringType() or isinstance(kind, (
        T.BooleanType, T.IntegralType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType))


def require_unique(source: DataFrame, keys: list[str], null_safe: bool = True) -> None:
    """Raise when a key occurs twice in ``source`` (one aggregation; one row comes
    back).  Under plain ``=`` a key with a NULL matches nothing and may repeat."""
    rows = source if null_safe else source.dropna(subset=keys)
    # Equal keys have equal hashes, and a hash is less to shuffle than the key.
    if all(hashable(source.schema[k].dataType) for k in keys) and \
            rows.groupBy(F.xxhash64(*keys).alias("h")).count().where("count > 1").isEmpty():
        return
    twice = rows.groupBy(*keys).count().where("count > 1").first()
    if twice is not None:
        raise ValueError(f"merge source has {twice['count']} rows for key "
                         f"{ {k: twice[k] for k in keys} }")


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str],
                 hash_col: str | None = None, null_safe: bool = True) -> DataFrame:
    """Merge ``source`` into ``target`` on ``keys``.

    ``hash_col``: update a matched row only when ``target.hash <> source.hash``
    (NULL on either side counts as unchanged).  ``None`` updates every match.
    Columns of the result are the target's; the source must have them all.
    """
    cols = target.columns
    missing = [c for c in cols if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns: {missing}")
    s = source.select(*[F.col(c).alias(_S + c) for c in cols], F.lit(True).alias(_HIT))
    on = _key_condition(keys, null_safe)
    take = F.col(_HIT).isNotNull()
    if hash_col is not None:
        take = take & F.coalesce(F.col(hash_col) != F.col(_S + hash_col), F.lit(False))
    kept = target.join(s, on, "left").select(
        *[F.when(take, F.col(_S + c)).otherwise(F.col(c)).alias(c) for c in cols])
    new = s.join(target.select(*keys), on, "left_anti").select(*[F.col(_S + c).alias(c) for c in cols])
    return kept.unionByName(new)


def key_matches(target: DataFrame, source: DataFrame, keys: list[str], null_safe: bool,
                place: list[str]) -> DataFrame:
    """Per key hash that is in ``source`` twice, or in ``source`` and ``target``: its rows on
    either side (``n_s``, ``n_t``), and where those are (``s_`` and ``t_`` + ``place``; of one
    row, if there are several).  A hash and a place per row are all that is shuffled."""
    def side(df: DataFrame, own: str, other: str) -> DataFrame:
        rows = df if null_safe else df.dropna(subset=keys)
        return rows.select(F.xxhash64(*keys).alias("h"), F.lit(1).alias(f"n_{own}"), F.lit(0).alias(f"n_{other}"),
                           *[F.col(p).alias(f"{own}_{p}") for p in place],
                           *[F.lit(None).cast(df.schema[p].dataType).alias(f"{other}_{p}") for p in place])

    both = side(source, "s", "t").unionByName(side(target, "t", "s"))
    per_key = both.groupBy("h").agg(F.sum("n_s").alias("n_s"), F.sum("n_t").alias("n_t"),
                                    *[F.max(f"{x}_{p}").alias(f"{x}_{p}") for x in "st" for p in place])
    return per_key.where("n_s > 1 OR n_s = 1 AND n_t > 0")


def kept_rows(target: DataFrame, source: DataFrame, matches: DataFrame, keys: list[str], null_safe: bool,
              place: list[str]) -> DataFrame:
    """The rows of ``target`` without a key in ``source``; ``matches``: their ``key_matches``,
    which tell in which places of ``source`` such a key can be."""
    at = F.broadcast(matches.select(*[F.col(f"s_{p}") for p in place]).distinct())
    s = source.join(at, reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.col(f"s_{p}")) for p in place]), "left_semi")
    return target.join(s.select(*[F.col(k).alias(_S + k) for k in keys]), _key_condition(keys, null_safe), "left_anti")


def effective_rows(target: DataFrame, source: DataFrame, keys: list[str], hash_col: str | None,
                   null_safe: bool, place: list[str]) -> tuple[DataFrame, DataFrame]:
    """What a merge does to ``target``, from its keys, hash and ``place`` columns alone:
    (the source rows that are new or replace some row, the ``place`` values of the rows
    they replace).  Merging only these rows into only those places gives the same table.
    """
    s = source.select(*[F.col(c).alias(_S + c) for c in dict.fromkeys([*keys, *([hash_col] if hash_col else [])])])
    slim = target.select(*dict.fromkeys([*keys, *([hash_col] if hash_col else []), *place]))
    changes = F.lit(True) if hash_col is None else F.coalesce(F.col(hash_col) != F.col(_S + hash_col), F.lit(False))
    hits = slim.join(s, _key_condition(keys, null_safe)).withColumn(_HIT, changes)
    per_key = hits.groupBy(*[_S + k for k in keys]).agg(F.max(_HIT).alias(_HIT))
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(_S + k)) for k in keys])
    rows = source.join(per_key, on, "left").where(F.coalesce(_HIT, F.lit(True))).select(*source.columns)
    return rows, hits.where(_HIT).select(*place).distinct()
