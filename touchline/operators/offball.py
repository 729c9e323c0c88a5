"""Off-ball value: control, transition and value of places multiplied, and how well passes were timed and aimed.

Places are in a 120 x 80 pitch. The surface is expressions over the cells of a frame; the values of passes come from one kernel over the
players' arrays of an Arrow batch."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Pitch, its metres, cells of a grid, spreads of the ball's reach, spread of the default transition, ends of the default value.
LENGTH, WIDTH, METRES, CELLS = 120.0, 80.0, (105.0, 68.0), (104, 68)
REACH, SPREAD, VALUE = (30.0, 20.0), 0.3, (0.01, 0.3)
#: Fixed values of pitch control: reaction, acceleration, spread of arrivals, bound of the exponent, least total influence.
REACTION, ACCELERATION, ARRIVALS, STEEPEST, LEAST = 0.7, 7.0, 0.45, 50.0, 1e-10
Surface = Callable


def default_transition(u, v, exp: Callable = F.exp):
    """How readily the ball reaches a place: falls off from the middle (shares of length and width; columns, or arrays with NumPy's ``exp``)."""
    return exp(-((u - 0.5) ** 2 + (v - 0.5) ** 2) / (2 * SPREAD**2))


def default_value(u, v):
    """What the ball is worth at a place: rises along the pitch."""
    return VALUE[0] + (VALUE[1] - VALUE[0]) * u


def off_ball_value(cells: DataFrame, frame: list[str], transition: Surface = default_transition, value: Surface = default_value) -> DataFrame:
    """``cells`` with ``off_ball_value``: control times transition times value, between 0 and 1.

    ``cells`` has ``*frame, control``, the cell's place ``x, y`` and the ball's ``ball_x, ball_y``. The transition is weighed by the ball's reach and divided by its
    greatest of the frame, if that is above 1e-10. Null where something is null."""
    u, v = F.col("x") / LENGTH, F.col("y") / WIDTH
    weight = F.exp(-((F.col("x") - F.col("ball_x")) ** 2) / (2 * REACH[0] ** 2) - (F.col("y") - F.col("ball_y")) ** 2 / (2 * REACH[1] ** 2))
    rows = cells.withColumn("__t", transition(u, v) * weight)
    most = F.max("__t").over(Window.partitionBy(*frame))  # the cells of a frame
    part = F.when(most > LEAST, F.col("__t") / most).otherwise(F.col("__t"))
    whole = F.col("control") * part * value(u, v)
    return rows.withColumn("off_ball_value", F.when(whole.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), whole)))).drop("__t")


def _padded(lists: pa.Array, fields: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(values, there): the fields of arrays of structs as (rows, longest, fields), and which places are used."""
    n = np.asarray(lists.value_lengths().fill_null(0))
    there = np.arange(n.max(initial=0)) < n[:, None]
    flat, out = lists.flatten(), np.zeros((*there.shape, len(fields)))
    for k, field in enumerate(fields):
        out[there, k] = flat.field(field).cast(pa.float64()).to_numpy(zero_copy_only=False)
    return out, there


def control_at(players: np.ndarray, there: np.ndarray, points: np.ndarray, dt: np.ndarray) -> np.ndarray:
    """The home side's control (rows, points) of points (rows, points, 2) ``dt`` (rows or 1, points) seconds on.

    ``players`` is (rows, players, 5): home, x, y, vx, vy in pitch units, of those that are ``there``; they go straight on and stay in the pitch. 1 or 0 if the
    other side has no players, 0.5 without any influence."""
    scale = np.array(METRES) / [LENGTH, WIDTH]
    home = (players[:, None, :, 0] > 0) & there[:, None]
    away = ~home & there[:, None]
    v = players[:, None, :, 3:5]
    at = np.clip(players[:, None, :, 1:3] + v * dt[:, :, None, None], 0, [LENGTH, WIDTH]) * scale
    way = points[:, :, None] * scale - at
    d = np.hypot(way[..., 0], way[..., 1])
    along = (v * scale * way).sum(axis=3) / np.where(d > 0, d, 1)
    t = np.maximum(REACTION, REACTION + (np.sqrt(along**2 + 2 * ACCELERATION * d) - along) / ACCELERATION)

    def influence(own: np.ndarray, other: np.ndarray) -> np.ndarray:
        least = np.where(other, t, np.inf).min(axis=2, initial=np.inf)[:, :, None]
        with np.errstate(invalid="ignore"):
            late = np.clip(np.where(own, t - least, 0) * (math.pi / (math.sqrt(3.0) * ARRIVALS)), -STEEPEST, STEEPEST)
        return np.where(own, 1 / (1 + np.exp(late)), 0).sum(axis=2)

    h, a = influence(home, away), influence(away, home)
    any_h, any_a = home.any(axis=2), away.any(axis=2)
    share = np.where(h + a > LEAST, h / np.maximum(h + a, LEAST), 0.5)
    return np.where(any_h & any_a, share, np.where(any_h, 1.0, np.where(any_a, 0.0, 0.5)))


def pass_values(passes: DataFrame, id_col: str, before: float = 3.0, after: float = 1.0, rate: float = 1.0, transition: Surface = default_transition, value: Surface = default_value) -> DataFrame:
    """``id_col, actual, peak, optimal, timing, aim, score`` of each pass.

    Passes have ``home``, the target ``end_x, end_y``, ``players``, an array of ``home, x, y, vx, vy``, and ``mates``, an array of ``x, y``: a frame's players, so both are small. The value of
    a place is the passing side's control of it times transition and value of its cell. ``actual`` is the target's at the pass, ``peak`` its greatest from ``before`` seconds before to ``after``
    after, ``rate`` times a second, ``optimal`` the greatest of target and mates. ``timing`` is actual / peak, ``aim`` actual / optimal, 0 where the divisor is 0, and ``score`` their product.
    Passes without a target have nulls."""
    kind = passes.schema[id_col].dataType.simpleString()
    steps = np.arange(-int(before * rate), int(after * rate) + 1) / rate
    names = ["actual", "peak", "optimal", "timing", "aim", "score"]

    def run(batches):
        for batch in batches:
            end = np.stack([batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in ("end_x", "end_y")], axis=1)
            known = ~np.isnan(end).any(axis=1)
            end = np.where(known[:, None], end, 0)
            players, there = _padded(batch.column("players"), ["home", "x", "y", "vx", "vy"])
            mates, mate = _padded(batch.column("mates"), ["x", "y"])
            home = np.asarray(batch.column("home").fill_null(False).to_numpy(zero_copy_only=False), bool)

            def worth(points: np.ndarray, dt: np.ndarray) -> np.ndarray:
                control = control_at(players, there, points, dt)  # noqa: B023
                u, v = (np.floor(np.clip(points[..., k] / most * (n - 1), 0, n - 1)) / (n - 1) for k, (most, n) in enumerate(zip((LENGTH, WIDTH), CELLS, strict=True)))
                return np.clip(np.where(home[:, None], control, 1 - control) * transition(u, v, np.exp) * value(u, v), 0, 1)  # noqa: B023

            moments = worth(np.repeat(end[:, None], len(steps), axis=1), steps[None])
            actual = worth(end[:, None], np.zeros((1, 1)))[:, 0]
            others = np.where(mate, worth(mates, np.zeros((1, mates.shape[1]))), 0).max(axis=1, initial=0)
            peak, optimal = np.maximum(actual, moments.max(axis=1)), np.maximum(actual, others)
            timing, aim = (np.where(of > 0, np.clip(actual / np.where(of > 0, of, 1), 0, 1), 0) for of in (peak, optimal))
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(x, pa.float64(), mask=~known) for x in (actual, peak, optimal, timing, aim, timing * aim))], names=[id_col, *names])

    own = passes.select(F.col(id_col).alias("id"), "home", "end_x", "end_y", "players", "mates")
    return own.mapInArrow(run, f"{id_col} {kind}, " + ", ".join(f"{n} double" for n in names))
