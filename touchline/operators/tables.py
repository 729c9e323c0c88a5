"""Keyed tables: surrogate keys, upserts, null-tolerant outer joins and new-row discovery."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Stands for null inside a surrogate key (fixed value).
NULL_MARK = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*columns: str) -> Column:
    """MD5 of the columns as strings, joined by '-', nulls marked."""
    return F.md5(F.concat_ws("-", *(F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARK)) for c in columns)))


def upsert(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` with rows of equal keys replaced by those of ``changes``, whose other rows are added. Null keys match."""
    same = reduce(lambda a, b: a & b, [target[k].eqNullSafe(changes[k]) for k in keys])
    return target.join(changes, same, "left_anti").unionByName(changes, allowMissingColumns=True)


def full_outer(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join on null-tolerant keys; keys come once."""
    l, r = left.alias("l"), right.alias("r")
    same = reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
    return l.join(r, same, "full_outer").select(*(F.coalesce(f"l.{k}", f"r.{k}").alias(k) for k in keys), *(F.col(f"l.{c}") for c in left.columns if c not in keys), *(F.col(f"r.{c}") for c in right.columns if c not in keys))
