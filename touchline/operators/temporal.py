"""Joins and windows over time: latest state, as-of with tolerance, band and nearest joins, sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_state(events: DataFrame, by: list[str], order: list[str], state: dict[str, Column]) -> DataFrame:
    """``events`` with, for each entry of ``state``, its last non-null value in a strictly earlier row of the same ``by``.

    One shuffle on ``by`` and no self-join: states are the rows where the column is not null."""
    before = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return events.withColumns({name: F.last(value, ignorenulls=True).over(before) for name, value in state.items()})


def asof_join(left: DataFrame, right: DataFrame, by: list[str], on: str, tie: str, take: list[str], within: Column | None = None) -> DataFrame:
    """Each left row with ``take`` of the latest right row of the same ``by`` at or before it (null if none).

    Both sides are put in one table and carried forward by a window, so a key costs its rows once, never their product.
    Of right rows at one time the one with the largest ``tie`` counts. ``within``: a condition on ``on`` and ``right_on``."""
    own = [c for c in left.columns if c not in by]
    wide = left.select(*by, F.col(on).alias("__at"), F.lit(1).alias("__side"), F.lit(None).cast(right.schema[tie].dataType).alias("__tie"), F.struct(*own).alias("__own"), F.lit(None).cast(right.select(F.struct(on, *take)).schema[0].dataType).alias("__state"))
    tall = right.select(*by, F.col(on).alias("__at"), F.lit(0).alias("__side"), F.col(tie).alias("__tie"), F.lit(None).cast(wide.schema["__own"].dataType).alias("__own"), F.struct(on, *take).alias("__state"))
    carried = Window.partitionBy(*by).orderBy("__at", "__side", "__tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = wide.unionByName(tall).withColumn("__state", F.last("__state", ignorenulls=True).over(carried)).where("__side = 1")
    out = out.select(*by, "__own.*", F.col(f"__state.{on}").alias(f"right_{on}"), *(F.col(f"__state.{c}").alias(f"right_{c}") for c in take))
    if within is None:
        return out
    return out.withColumns({f"right_{c}": F.when(within, F.col(f"right_{c}")) for c in [*take, on]})


def band_join(left: DataFrame, right: DataFrame, by: list[str], left_on: str, right_on: str, before: float, after: float) -> DataFrame:
    """Pairs of the same ``by`` with ``-before <= right_on - left_on <= after`` (seconds; timestamps or numbers).

    Left rows go to each cell of the band's width that they can reach, so the join is an equi-join on (by, cell)."""
    width = before + after
    number = lambda c: F.unix_micros(c) / 1e6 if "timestamp" in kind else F.col(c).cast("double")
    kind = left.schema[left_on].dataType.simpleString()
    kind = "timestamp" if kind == "timestamp_ntz" else kind
    stamp = lambda df, c: df.withColumn("__t_" + c, number(c) if kind != "timestamp" else F.unix_micros(F.col(c).cast("timestamp")) / 1e6)
    cell = lambda c: F.floor(c / width)
    at, to = F.col("__t_" + left_on), F.col("__t_" + right_on)
    near = stamp(left, left_on).withColumn("__cell", F.explode(F.sequence(cell(at - before), cell(at + after))))
    far = stamp(right, right_on).withColumn("__cell", cell(to))
    gap = to - at
    return near.join(far, [*by, "__cell"]).where((gap >= -before) & (gap <= after)).withColumn("gap", gap).drop("__cell", "__t_" + left_on, "__t_" + right_on)


def sessions(events: DataFrame, by: list[str], on: str, tie: str, gap_seconds: int) -> DataFrame:
    """``events`` with ``session_no`` from 0: a new session starts after a gap of more than ``gap_seconds``."""
    order = Window.partitionBy(*by).orderBy(on, tie)
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    new = F.coalesce(micros(F.col(on)) - micros(F.lag(on).over(order)) > gap_seconds * 1_000_000, F.lit(False)).cast("long")
    return events.withColumn("__new", new).withColumn("session_no", F.sum("__new").over(order)).drop("__new")


def lead_in_parts(rows: DataFrame, by: list[str], part: Column, order: list[str], columns: dict[str, str]) -> DataFrame:
    """``rows`` with the next row's values of ``columns`` (old name to new) in a group's order.

    ``part`` must not fall along the order (an hour, for example). Rows look ahead inside their part; the last one of a part takes the first of the next
    part there is, from a table with a row a part. So a group that holds a third of all rows is worked on by many tasks."""
    rows, value = rows.withColumn("__part", part), F.struct(*columns)
    first = rows.groupBy(*by, "__part").agg(F.min_by(value, F.struct(*order)).alias("__first"))
    first = first.select(*by, "__part", F.lead("__first").over(Window.partitionBy(*by).orderBy("__part")).alias("__next"))
    inside = F.lead(value).over(Window.partitionBy(*by, "__part").orderBy(*order))
    ahead = rows.withColumn("__ahead", inside).join(first, [*by, "__part"], "left").withColumn("__ahead", F.coalesce("__ahead", "__next"))
    return ahead.select(*(c for c in rows.columns if c != "__part"), *(F.col(f"__ahead.{c}").alias(new) for c, new in columns.items()))
