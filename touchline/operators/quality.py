"""Checks that return the rows that break them: none is a pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def failures(rows: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One row per check with the number of rows that break it (a condition that is false or null), in one pass."""
    counted = rows.agg(*(F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in checks.items()))
    return counted.unpivot([], list(checks), "check_name", "failures")


def repeated_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def orphans(rows: DataFrame, parents: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows with a key that no parent has; rows with a null key are not orphans."""
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(p) for k, p in on.items()])
    return rows.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in on])).join(parents, same, "left_anti")


def reconciled(left: DataFrame, right: DataFrame, keys: list[str], value: str, within: float = 0.01) -> DataFrame:
    """Keys whose two totals differ by more than ``within``, or that one side lacks."""
    both = left.select(*keys, F.col(value).alias("left_total")).join(right.select(*keys, F.col(value).alias("right_total")), keys, "full_outer")
    return both.where(F.coalesce(F.abs(F.col("left_total") - F.col("right_total")) > within, F.lit(True)))
