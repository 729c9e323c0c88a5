"""Registered queries over ordered state: ratings, and kernels over groups carried across batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from touchline.operators.kinematics import halo_windows
from touchline.plans.base import query
from touchline.sources.shared import shared_path, table
from touchline.streaming.groups import map_groups
from touchline.streaming.ratings import Ratings


def duels(spark, d):
    """Games from events: in an hour each user meets the next one, and the higher value wins; a week is a period."""
    after = Window.partitionBy(F.date_trunc("hour", "ts")).orderBy("ts", "event_id")
    pairs = table(spark, d, "events").select(F.floor(F.datediff(F.col("ts").cast("date"), F.lit("2020-01-06").cast("date")) / 7).alias("period"), F.col("user_id").alias("a"), "value", F.lead("user_id").over(after).alias("b"), F.lead("value").over(after).alias("other"))
    pairs = pairs.where("b is not null and a <> b and value <> other")
    won = F.col("value") > F.col("other")
    return pairs.select("period", F.when(won, F.col("a")).otherwise(F.col("b")).alias("winner"), F.when(won, F.col("b")).otherwise(F.col("a")).alias("loser"))


@query(None)
def d19_duel_ratings(spark, d):
    """Glicko-2 ratings of the users after each week."""
    ratings = Ratings(spark, shared_path(spark, "ratings"))
    ratings.advance(duels(spark, d), 0, close=True)
    return ratings.ratings().select("player", "last_period", *(F.round(c, 6).alias(c) for c in ("rating", "deviation", "volatility")), "contested", "won", "lost")


def _medians(group: pa.Table) -> pa.Table:
    """The median of each row's value and those of up to three rows before and after it."""
    v = group.column("value").to_numpy()
    wide = np.concatenate([np.full(3, np.nan), v, np.full(3, np.nan)])
    return pa.table({"event_id": group.column("event_id"), "median": np.nanmedian(np.lib.stride_tricks.sliding_window_view(wide, 7), axis=1)})


@query("""SELECT event_id, median(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS median FROM events""")
def x02_carried_medians(spark, d):
    """Running medians in windows of 20 rows with a halo of 3, groups carried across batches."""
    rows = halo_windows(table(spark, d, "events").select("event_id", "user_id", "ts", "value"), ["user_id"], ["ts", "event_id"], size=20, halo=3)
    return map_groups(rows, ["user_id", "window_no"], ["ts", "event_id"], _medians, "event_id long, median double", halo="is_halo")
