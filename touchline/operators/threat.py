"""Value of pitch zones from moves and shots, and credits of defenders around an action. Places are in metres, 105 x 68."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Zones along and across the pitch, its metres, and the greatest change at which values have settled (fixed values).
ZONES, PITCH, SETTLED = (16, 12), (105.0, 68.0), 1e-5
#: Rounds after which values that still change are an error.
MOST_ROUNDS = 1000
#: Metres in which a defender disturbs, degrees of the cone to the goal in which it deters, the goal, and actions that intercept (fixed values).
DISTURBED, CONE, GOAL, INTERCEPTING = 5.0, 15.0, (105.0, 34.0), ["tackle", "interception", "clearance"]


def zone(x: Column, y: Column) -> Column:
    """The zone of a place: rows from the far side down, in each from left to right; places beyond the pitch are in the zone at its edge."""
    across = lambda v, metres, n: F.least(F.greatest((v / (metres / n)).cast("int"), F.lit(0)), F.lit(n - 1))
    return (ZONES[1] - 1 - across(y, PITCH[1], ZONES[1])) * ZONES[0] + across(x, PITCH[0], ZONES[0])


def zone_counts(actions: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """(``*by, zone, shots, goals, moves, starts``; ``*by, zone, to_zone, n``): counts of shots and moves, and of successful moves between zones.

    ``actions`` has ``is_shot, is_move, success, x, y, end_x, end_y``. Rows without a start don't count; ``starts`` are moves that have an end as well.
    Counts add up: those of all groups together are the sums over the groups."""
    rows = actions.where("x is not null and y is not null and (is_shot or is_move)").withColumn("zone", zone(F.col("x"), F.col("y")))
    ended = F.col("end_x").isNotNull() & F.col("end_y").isNotNull()
    count = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    zones = rows.groupBy(*by, "zone").agg(count(F.col("is_shot")).alias("shots"), count(F.col("is_shot") & F.col("success")).alias("goals"), count(F.col("is_move")).alias("moves"), count(F.col("is_move") & ended).alias("starts"))
    ways = rows.where(F.col("is_move") & F.col("success") & ended).withColumn("to_zone", zone(F.col("end_x"), F.col("end_y")))
    return zones, ways.groupBy(*by, "zone", "to_zone").agg(F.count(F.lit(1)).alias("n"))


def settled_values(shot: np.ndarray, move: np.ndarray, ways: np.ndarray, settled: float = SETTLED) -> tuple[np.ndarray, int]:
    """(values, rounds): shot + move * (ways @ values), repeated until no value rises by more than ``settled``."""
    value = np.zeros(len(shot))
    for rounds in range(1, MOST_ROUNDS + 1):
        new = shot + move * (ways @ value)
        if np.abs(new - value).max(initial=0) <= settled:
            return new, rounds
        value = new
    raise RuntimeError(f"values did not settle in {MOST_ROUNDS} rounds")


def expected_threat(actions: DataFrame, by: list[str], settled: float = SETTLED) -> DataFrame:
    """``*by, zone, value, rounds``: of each of the 192 zones the chance that the ball there comes to a goal.

    A zone's value is the chance of a shot times that of a goal from it, and the chance of a move times the values of the zones it comes to. Zones without
    actions are worth 0. The counts are aggregates over all rows; what goes to a group's task are they, 192 zones and the ways between them at most."""
    zones, ways = zone_counts(actions, by)
    n = ZONES[0] * ZONES[1]
    rows = zones.select(*by, "zone", F.lit(-1).alias("to_zone"), "shots", "goals", "moves", "starts").unionByName(ways.select(*by, "zone", "to_zone", *(F.col("n").alias(c) if c == "shots" else F.lit(0).cast("long").alias(c) for c in ("shots", "goals", "moves", "starts"))))

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        own, moved = group[group["to_zone"] < 0], group[group["to_zone"] >= 0]
        at = own["zone"].to_numpy()
        shots, goals, moves, starts = (np.bincount(at, own[c].to_numpy(float), n) for c in ("shots", "goals", "moves", "starts"))
        matrix = np.zeros((n, n))
        np.add.at(matrix, (moved["zone"].to_numpy(), moved["to_zone"].to_numpy()), moved["shots"].to_numpy(float))
        share = lambda a, b: np.divide(a, b, out=np.zeros_like(a), where=b > 0)
        acts = shots + moves
        value, rounds = settled_values(share(goals, acts), share(moves, acts), share(matrix, np.repeat(starts[:, None], n, axis=1)), settled)
        return pd.DataFrame({**{c: group[c].iloc[0] for c in by}, "zone": np.arange(n, dtype="int32"), "value": value, "rounds": np.int32(rounds)})

    kinds = "".join(f"{c} {rows.schema[c].dataType.simpleString()}, " for c in by)
    return rows.groupBy(*by).applyInPandas(fit, f"{kinds}zone int, value double, rounds int")


def defensive_credits(pairs: DataFrame, action: str, defender: str) -> DataFrame:
    """``action, defender, credit, distance``: what each defender near an action did, one credit at most.

    ``pairs`` has a row for each action and defender of its frame: ``action_type, actor, action_x, action_y, value`` and the defender's ``x, y``. In this order: ``intercept`` if the
    defender is the actor of a tackle, interception or clearance; ``concede`` if the value is positive and it is the nearest of the others (ties: the smaller id); ``disturb`` within 5 metres;
    ``deter`` if the value is negative and it stands within 15 degrees of the way from the ball to the goal. Pairs without places have none."""
    rows = pairs.where("action_x is not null and action_y is not null and x is not null and y is not null")
    dx, dy = F.col("x") - F.col("action_x"), F.col("y") - F.col("action_y")
    rows = rows.withColumn("distance", F.sqrt(dx * dx + dy * dy))
    actor = F.col("action_type").isin(INTERCEPTING) & (F.col("actor") == F.col(defender))
    rows = rows.withColumn("__intercepts", F.coalesce(actor, F.lit(False)))
    nearest = F.row_number().over(Window.partitionBy(action).orderBy("__intercepts", "distance", defender)) == 1  # a frame's defenders
    gx, gy = GOAL[0] - F.col("action_x"), GOAL[1] - F.col("action_y")
    length = F.sqrt(gx * gx + gy * gy)
    cosine = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (gx * dx + gy * dy) / (length * F.col("distance"))))
    deters = (length >= 1e-9) & (F.col("distance") >= 1e-9) & (F.degrees(F.acos(cosine)) <= CONE)
    credit = F.when(F.col("__intercepts"), "intercept").when((F.col("value") > 0) & nearest, "concede").when(F.col("distance") <= DISTURBED, "disturb").when((F.col("value") < 0) & deters, "deter")
    return rows.withColumn("credit", credit).where("credit is not null").select(action, defender, "credit", "distance")
