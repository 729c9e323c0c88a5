"""Expressions and windows over moving positions: smoothing, spikes, halo windows and control of a point."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def smoothed(rows: DataFrame, by: list[str], order: list[str], value: str, window: int = 7, degree: int = 2, out: str = "smoothed") -> DataFrame:
    """``rows`` with the least-squares polynomial of ``degree`` over ``window`` rows, read at each row.

    The first and last rows read the polynomial of the first and last whole window; groups with fewer rows keep their values.
    One shuffle on ``by``: weights are constants, neighbours come by lag."""
    x = np.vander(np.arange(window), degree + 1, increasing=True)
    weights, half = x @ np.linalg.pinv(x), window // 2
    ordered = Window.partitionBy(*by).orderBy(*order)
    n, i = F.count(F.lit(1)).over(Window.partitionBy(*by)), F.row_number().over(ordered) - 1
    at = lambda row: reduce(lambda a, b: a + b, [F.lag(value, row - k).over(ordered) * float(weights[row, k]) for k in range(window)])
    ladder = F.when(F.col("__n") < window, F.col(value))
    for row in range(half):
        ladder = ladder.when(F.col("__i") == row, at(row)).when(F.col("__n") - 1 - F.col("__i") == row, at(window - 1 - row))
    return rows.withColumns({"__n": n, "__i": i}).withColumn(out, ladder.otherwise(at(half))).drop("__n", "__i")


def halo_windows(rows: DataFrame, by: list[str], order: list[str], size: int, halo: int) -> DataFrame:
    """``rows`` in windows of ``size`` consecutive rows, with ``window_no`` and ``is_halo``.

    Each window also holds copies of the ``halo`` (at most ``size``) rows before and after it, marked by ``is_halo``."""
    ordinal = (F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1).cast("long")
    rows = rows.withColumn("__o", ordinal).withColumn("__last", F.floor((F.count(F.lit(1)).over(Window.partitionBy(*by)) - 1) / size))
    own, place = F.floor(F.col("__o") / size), F.col("__o") % size
    copies = F.filter(F.array(own, F.when(place < halo, own - 1), F.when(place >= size - halo, own + 1)), lambda w: w.isNotNull() & (w >= 0) & (w <= F.col("__last")))
    return rows.withColumn("window_no", F.explode(copies)).withColumn("is_halo", F.col("window_no") != own).drop("__o", "__last")


def arrival_time(x: Column, y: Column, vx: Column, vy: Column, to_x: Column, to_y: Column, reaction: float = 0.7, acceleration: float = 7.0) -> Column:
    """Seconds until a player at (x, y) with velocity (vx, vy) reaches a point: reaction, then constant acceleration."""
    dx, dy = to_x - x, to_y - y
    d = F.sqrt(dx * dx + dy * dy)
    along = F.when(d > 0, (vx * dx + vy * dy) / d).otherwise(F.lit(0.0))
    return F.lit(reaction) + (F.sqrt(along * along + F.lit(2 * acceleration) * d) - along) / F.lit(acceleration)


def control_share(home: Column, arrival: Column, fastest: Column, spread: float = 0.45) -> Column:
    """Aggregate: the home side's share of logistic influence on a point, given each player's arrival and the least one."""
    influence = 1 / (1 + F.exp((arrival - fastest) * (np.pi / np.sqrt(3.0) / spread)))
    return F.sum(F.when(home, influence).otherwise(0.0)) / F.sum(influence)


def control_surface(players: DataFrame, frame: list[str], home: Column, columns: int = 50, rows: int = 32, length: float = 105.0, width: float = 68.0, spread: float = 0.45) -> DataFrame:
    """``*frame, cell, home_control``: the home side's share of influence on each point of an even grid that
    includes the edges; cell = row * columns + column.

    ``players`` has x, y, vx, vy in metres and metres a second; rows without one of them are left out. Each player is compared
    with the opponents' least arrival; where one side has no players, all is the other's. One shuffle, by frame: a frame holds
    two teams, so a task's group is small; Arrow carries it to the kernel."""
    gx, gy = np.meshgrid(np.linspace(0, length, columns), np.linspace(0, width, rows))
    gx, gy, steep = gx.ravel(), gy.ravel(), np.pi / np.sqrt(3.0) / spread

    def arrivals(p: pd.DataFrame) -> np.ndarray:
        x, y, vx, vy = (p[c].to_numpy(float)[:, None] for c in ("x", "y", "vx", "vy"))
        d = np.hypot(gx - x, gy - y)
        along = (vx * (gx - x) + vy * (gy - y)) / np.maximum(d, 1e-10)
        return 0.7 + np.maximum((np.sqrt(along * along + 14.0 * d) - along) / 7.0, 0.0)

    def share(p: pd.DataFrame) -> pd.DataFrame:
        own = p["__home"].to_numpy(bool)
        if own.all() or not own.any():
            control = np.full(len(gx), 1.0 if own.all() else 0.0)
        else:
            h, a = arrivals(p[own]), arrivals(p[~own])
            influence = lambda t, least: (1 / (1 + np.exp(np.clip((t - least.min(axis=0)) * steep, -50.0, 50.0)))).sum(axis=0)
            hi, ai = influence(h, a), influence(a, h)
            control = np.where(hi + ai > 1e-10, hi / np.maximum(hi + ai, 1e-10), 0.5)
        return pd.DataFrame({**{c: p[c].iloc[0] for c in frame}, "cell": np.arange(len(gx), dtype="int32"), "home_control": control})

    places = players.where("x is not null and y is not null and vx is not null and vy is not null")
    places = places.select(*frame, F.coalesce(home, F.lit(False)).alias("__home"), *(F.col(c).cast("double").alias(c) for c in ("x", "y", "vx", "vy")))
    schema = T.StructType([*places.select(*frame).schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("home_control", T.DoubleType())])
    return places.groupBy(*frame).applyInPandas(share, schema)
