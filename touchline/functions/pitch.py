"""Column functions over pitch coordinates: systems, progress of a pass, tokens of a grid."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The common pitch in units, a pitch in metres, the goal's centre, and the share that a progressive pass leaves.
LENGTH, WIDTH, LENGTH_M, WIDTH_M = 120.0, 80.0, 105.0, 68.0
GOAL, PROGRESS = (120.0, 40.0), 0.75


def normalized(x: Column, y: Column, system: str) -> tuple[Column, Column]:
    """(x, y) on the common 120 x 80 pitch; an unknown system is an error when the plan is built. Nulls stay null."""
    if system == "metrica":  # 0 to 1, y from the top
        return x * LENGTH, (1 - y) * WIDTH
    if system == "center_m":  # metres from the centre
        return (x + LENGTH_M / 2) * (LENGTH / LENGTH_M), (y + WIDTH_M / 2) * (WIDTH / WIDTH_M)
    if system == "pitch_m":  # metres from a corner
        return x * (LENGTH / LENGTH_M), y * (WIDTH / WIDTH_M)
    if system == "pct":  # 0 to 100
        return x * (LENGTH / 100), y * (WIDTH / 100)
    raise ValueError(f"unknown coordinate system {system!r}")


def progressive(x: Column, y: Column, end_x: Column, end_y: Column) -> Column:
    """Whether a pass ends at less than PROGRESS of its distance to the goal; null if a coordinate is."""
    to_goal = lambda a, b: F.sqrt((F.lit(GOAL[0]) - a) * (F.lit(GOAL[0]) - a) + (F.lit(GOAL[1]) - b) * (F.lit(GOAL[1]) - b))
    return to_goal(end_x, end_y) < F.lit(PROGRESS) * to_goal(x, y)


def grid_token(action: Column, x: Column, y: Column, columns: int = 12, rows: int = 8) -> Column:
    """``action_gx_gy``: the cell of a 105 x 68 m pitch; places beyond an edge belong to the nearest cell."""
    cell = lambda v, size, n: F.greatest(F.least(F.floor(v / size * n), F.lit(n - 1)), F.lit(0)).cast("int").cast("string")
    return F.concat_ws("_", action, cell(x, LENGTH_M, columns), cell(y, WIDTH_M, rows))
