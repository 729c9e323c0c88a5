"""Glicko-2 ratings: ordered state over rating periods, the same in a batch and on a stream.

A period is rated at once for all players by joins and partial sums, from the ratings that players and opponents had before it. Only
periods follow one another. The state is a table with a row per player; on a stream each micro-batch writes its next version."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rating, deviation and volatility of a new player, Glicko points in a unit of the inner scale (fixed values), and the step of volatilities.
START, SCALE, TAU = (1500.0, 350.0, 0.06), 173.7178, 0.5
#: Rounds of the search for a volatility, and where it ends (fixed values).
ROUNDS, CLOSE = 60, 1e-6


def _volatility(delta: Column, phi: Column, v: Column, sigma: Column, tau: float) -> Column:
    """The volatility after a period: where the derivative of its likelihood is 0, by the Illinois variant of false position."""
    a = 2 * F.log(sigma)

    def f(x: Column) -> Column:
        e = F.exp(x)
        return e * (delta * delta - phi * phi - v - e) / (2 * (phi * phi + v + e) * (phi * phi + v + e)) - (x - a) / (tau * tau)

    steps = F.filter(F.sequence(F.lit(1), F.lit(100)), lambda k: f(a - k * tau) >= 0)
    b = F.when(delta * delta > phi * phi + v, F.log(delta * delta - phi * phi - v)).otherwise(a - F.coalesce(F.get(steps, F.lit(0)), F.lit(100)) * tau)
    first = F.struct(a.alias("a"), b.alias("b"), f(a).alias("fa"), f(b).alias("fb"))

    def step(s: Column, _: Column) -> Column:
        c = s["a"] + (s["a"] - s["b"]) * s["fa"] / (s["fb"] - s["fa"])
        fc = f(c)
        other = fc * s["fb"] <= 0
        moved = F.struct(F.when(other, s["b"]).otherwise(s["a"]).alias("a"), c.alias("b"), F.when(other, s["fb"]).otherwise(s["fa"] / 2).alias("fa"), fc.alias("fb"))
        return F.when(F.abs(s["b"] - s["a"]) > CLOSE, moved).otherwise(s)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), first, step, lambda s: F.exp(s["a"] / 2))


def rated_period(state: DataFrame, games: DataFrame, period, tau: float = TAU) -> DataFrame:
    """``player, rating, deviation, volatility, last_period, contested, won, lost`` of the players of one period's ``games`` (winner, loser).

    Players without a state start at 1500, 350 and 0.06. Games with a null player or of a player with itself don't count."""
    games = games.where("winner is not null and loser is not null and winner <> loser")
    sides = games.select(F.explode(F.array(F.struct(F.col("winner").alias("player"), F.col("loser").alias("opponent"), F.lit(1.0).alias("score")), F.struct(F.col("loser").alias("player"), F.col("winner").alias("opponent"), F.lit(0.0).alias("score")))).alias("g")).select("g.*")
    # Equal games are counted before anyone's rating is looked up.
    sides = sides.groupBy("player", "opponent", "score").agg(F.count(F.lit(1)).alias("n"))
    mu = lambda r: (r - START[0]) / SCALE
    other = state.select(F.col("player").alias("opponent"), F.col("rating").alias("orating"), F.col("deviation").alias("odeviation"))
    own = sides.join(state.select("player", "rating", "deviation", "volatility"), "player", "left").join(other, "opponent", "left")
    own = own.select("player", "score", "n", *(F.coalesce(F.col(c), F.lit(x)).alias(c) for c, x in zip(("rating", "deviation", "volatility"), START, strict=True)), F.coalesce("orating", F.lit(START[0])).alias("orating"), (F.coalesce("odeviation", F.lit(START[1])) / SCALE).alias("ophi"))
    g = 1 / F.sqrt(1 + 3 * F.col("ophi") ** 2 / math.pi**2)
    e = 1 / (1 + F.exp(-F.col("g") * (mu(F.col("rating")) - mu(F.col("orating")))))
    own = own.withColumn("g", g).withColumn("e", e)
    sums = own.groupBy("player", "rating", "deviation", "volatility").agg(
        F.sum(F.col("n") * F.col("g") ** 2 * F.col("e") * (1 - F.col("e"))).alias("information"),
        F.sum(F.col("n") * F.col("g") * (F.col("score") - F.col("e"))).alias("surprise"),
        F.sum("n").alias("contested"),
        F.sum(F.when(F.col("score") == 1, F.col("n")).otherwise(0)).alias("won"),
    )
    phi, v = F.col("deviation") / SCALE, 1 / F.col("information")
    out = sums.withColumn("sigma", _volatility(v * F.col("surprise"), phi, v, F.col("volatility"), tau))
    out = out.withColumn("phi", 1 / F.sqrt(1 / (phi**2 + F.col("sigma") ** 2) + F.col("information")))
    return out.select("player", (F.col("rating") + SCALE * F.col("phi") ** 2 * F.col("surprise")).alias("rating"), (F.col("phi") * SCALE).alias("deviation"), F.col("sigma").alias("volatility"), F.lit(period).cast("long").alias("last_period"), "contested", "won", (F.col("contested") - F.col("won")).alias("lost"))


class Ratings:
    """Ratings kept below ``root`` (shared by all executors), a version of every table for each call of ``advance``.

    Games have ``period`` (ordered whole numbers), ``winner, loser``. The newest period stays open until rows of a later one come, or
    until a call with ``close``. Rows of a period that is closed already are late: they are kept in ``late`` and not rated; rows without a
    period count nowhere. With ``expire``, a player who has not played for that many periods is forgotten and starts anew; without it
    the state has a row for each player ever seen. What is open is one period."""

    def __init__(self, spark: SparkSession, root: str, player: str = "long", tau: float = TAU, expire: int | None = None):
        self.spark, self.root, self.tau, self.expire = spark, root.rstrip("/"), tau, expire
        games, state = f"period long, winner {player}, loser {player}", f"player {player}, rating double, deviation double, volatility double, last_period long"
        self.kinds = {"games": games, "open": games, "late": games, "state": state, "ratings": state + ", contested long, won long, lost long"}

    def _read(self, table: str, version: int) -> DataFrame:
        if version < 0:
            return self.spark.createDataFrame([], self.kinds[table])
        return self.spark.read.schema(self.kinds[table]).parquet(f"{self.root}/{table}/{version}")

    def _write(self, df: DataFrame, path: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.root}/{path}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{path}")

    def advance(self, games: DataFrame, version: int, close: bool = False) -> None:
        """Rates the periods that ``games`` completes and writes this version of all tables, from the one before. A call that is
        repeated writes the same again."""
        state, held = self._read("state", version - 1), self._read("open", version - 1)
        # Periods before the open one are closed; with none open, those up to the last rated one.
        done = held.agg(F.min("period") - 1).first()[0]
        done = state.agg(F.max("last_period")).first()[0] if done is None else done
        rows = self._write(games.select(*held.columns).where("period is not null").unionByName(held), f"games/{version}")
        late = F.lit(False) if done is None else F.col("period") <= done
        self._write(rows.where(late), f"late/{version}")
        rows = rows.where(~late)
        newest = rows.agg(F.max("period")).first()[0]
        closed = rows if close else rows.where(F.col("period") < F.lit(newest))
        self._write(self._read("ratings", -1), f"ratings/{version}/none")
        for (period,) in sorted(closed.select("period").distinct().collect()):  # a row for each period of this version
            rated = self._write(rated_period(state, closed.where(F.col("period") == period), period, self.tau), f"ratings/{version}/{period}")
            kept = state.join(rated.select("player"), "player", "left_anti")
            if self.expire is not None:
                kept = kept.where(F.col("last_period") >= period - self.expire)
            state = self._write(kept.unionByName(rated.select(state.columns)), f"steps/{version}/{period}")
        self._write(state, f"state/{version}")
        self._write(rows.where(F.lit(False)) if close else rows.where(F.col("period") == F.lit(newest)), f"open/{version}")

    def ratings(self) -> DataFrame:
        """``player, rating, deviation, volatility, last_period, contested, won, lost`` after each rated period."""
        return self.spark.read.schema(self.kinds["ratings"]).option("recursiveFileLookup", "true").parquet(f"{self.root}/ratings")
