"""Ratings and carried groups against plain versions."""

import math
import random
from collections import defaultdict

import pyarrow as pa
import pytest
from touchline.streaming.groups import group_ends, map_groups, whole_groups
from touchline.streaming.ratings import Ratings, rated_period

GAMES = "period long, winner long, loser long"


def glicko(players, games, tau=0.5):
    """One period by the published steps; ``players`` maps to (rating, deviation, volatility)."""
    met = defaultdict(list)
    for w, l in games:
        met[w].append((l, 1.0))
        met[l].append((w, 0.0))
    out = dict(players)
    for p, own in met.items():
        r, rd, sigma = players.get(p, (1500.0, 350.0, 0.06))
        mu, phi = (r - 1500) / 173.7178, rd / 173.7178
        terms = []
        for o, s in own:
            ro, rdo, _ = players.get(o, (1500.0, 350.0, 0.06))
            g = 1 / math.sqrt(1 + 3 * (rdo / 173.7178) ** 2 / math.pi**2)
            e = 1 / (1 + math.exp(-g * (mu - (ro - 1500) / 173.7178)))
            terms.append((g, e, s))
        v = 1 / sum(g * g * e * (1 - e) for g, e, _ in terms)
        delta = v * sum(g * (s - e) for g, e, s in terms)
        a = math.log(sigma**2)
        f = lambda x: math.exp(x) * (delta**2 - phi**2 - v - math.exp(x)) / (2 * (phi**2 + v + math.exp(x)) ** 2) - (x - a) / tau**2  # noqa: B023, E731
        low = a
        if delta**2 > phi**2 + v:
            high = math.log(delta**2 - phi**2 - v)
        else:
            k = 1
            while f(a - k * tau) < 0:
                k += 1
            high = a - k * tau
        for _ in range(300):  # bisection, as an independent way to the same root
            mid = (low + high) / 2
            low, high = (mid, high) if f(low) * f(mid) > 0 else (low, mid)
        sigma2 = math.exp(low / 2)
        star = math.sqrt(phi**2 + sigma2**2)
        phi2 = 1 / math.sqrt(1 / star**2 + 1 / v)
        out[p] = (173.7178 * (mu + phi2**2 * sum(g * (s - e) for g, e, s in terms)) + 1500, phi2 * 173.7178, sigma2)
    return out


def league(seed=1):
    rnd = random.Random(seed)
    return [(p, *rnd.sample(range(9), 2)) for p in (1, 1, 1, 2, 2, 4, 4, 4, 4, 7, 8, 8, 9) for _ in range(rnd.randint(1, 4))]


def test_the_published_example(spark):
    """Glickman's example: a player of 1500 with deviation 200 wins against 1400, loses to 1550 and 1700."""
    state = spark.createDataFrame([(1, 1500.0, 200.0, 0.06, 0), (2, 1400.0, 30.0, 0.06, 0), (3, 1550.0, 100.0, 0.06, 0), (4, 1700.0, 300.0, 0.06, 0)], "player long, rating double, deviation double, volatility double, last_period long")
    r = rated_period(state, spark.createDataFrame([(1, 2), (3, 1), (4, 1)], "winner long, loser long"), 1).where("player = 1").first()
    assert (round(r.rating, 2), round(r.deviation, 2), round(r.volatility, 5)) == (1464.05, 151.52, 0.06)
    assert (r.contested, r.won, r.lost) == (3, 1, 2)


def expected(games):
    state, out = {}, {}
    for period in sorted({g[0] for g in games}):
        own = [(w, l) for p, w, l in games if p == period]
        state = glicko(state, own)
        out |= {(period, p): tuple(round(x, 3) for x in state[p]) for g in own for p in g}
    return out


def rounded(ratings):
    return {(r.last_period, r.player): (round(r.rating, 3), round(r.deviation, 3), round(r.volatility, 3)) for r in ratings.ratings().collect()}


def test_batch_equals_stream(spark, tmp_path):
    games = league()
    batch = Ratings(spark, f"{tmp_path}/batch")
    odd = [(None, 1, 2), (4, None, 3), (4, 5, 5)]
    batch.advance(spark.createDataFrame(games + odd, GAMES), 0, close=True)
    want = expected(games)
    assert rounded(batch) == {k: tuple(round(x, 3) for x in v) for k, v in want.items()}

    stream, parts = Ratings(spark, f"{tmp_path}/stream"), [games[:3], games[3:8], games[8:9], [], games[9:20], games[20:]]
    for k, part in enumerate(parts):
        spark.createDataFrame(part, GAMES).coalesce(1).write.parquet(f"{tmp_path}/in/part={k}")
    for k, part in enumerate(parts):
        stream.advance(spark.createDataFrame(part, GAMES), k)
        if k == 2:
            stream.advance(spark.createDataFrame(part, GAMES), k)  # a batch that is done again
    stream.advance(spark.createDataFrame([], GAMES), len(parts), close=True)
    assert rounded(stream) == rounded(batch)


def test_structured_stream(spark, tmp_path):
    games = league(4)
    for k in range(3):
        own = [g for g in games if k * 3 < g[0] <= k * 3 + 3]
        spark.createDataFrame(own, GAMES).coalesce(1).write.parquet(f"{tmp_path}/in{k}")
    ratings = Ratings(spark, f"{tmp_path}/ratings")
    last = -1
    for k in range(3):
        spark.read.parquet(f"{tmp_path}/in{k}").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        seen = []
        query = spark.readStream.schema(GAMES).parquet(f"{tmp_path}/in").writeStream.foreachBatch(lambda df, i: (ratings.advance(df, i), seen.append(i))[0]).option("checkpointLocation", f"{tmp_path}/marks").trigger(availableNow=True).start()  # noqa: B023
        query.awaitTermination()
        last = max(seen)
    ratings.advance(spark.createDataFrame([], GAMES), last + 1, close=True)
    assert rounded(ratings) == expected(games)


def test_late_rows_and_forgotten_players(spark, tmp_path):
    ratings = Ratings(spark, f"{tmp_path}/r", expire=2)
    ratings.advance(spark.createDataFrame([(1, 1, 2), (2, 3, 4), (3, 3, 4)], GAMES), 0)
    ratings.advance(spark.createDataFrame([(2, 1, 2), (4, 3, 4), (5, 1, 3)], GAMES), 1)
    ratings.advance(spark.createDataFrame([], GAMES), 2, close=True)
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_path}/r/late/1").collect()] == [(2, 1, 2)]
    state = {r.player: r for r in spark.read.parquet(f"{tmp_path}/r/state/2").collect()}
    assert set(state) == {1, 3, 4}  # 2 has not played since period 1, 1 came back
    before = {r.player: (r.rating, r.deviation, r.volatility) for r in spark.read.parquet(f"{tmp_path}/r/steps/1/4").collect()}
    assert set(before) == {3, 4}
    assert (state[1].rating, state[1].last_period) == (pytest.approx(glicko(before, [(1, 3)])[1][0], abs=1e-3), 5)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100])
def test_groups_across_batches(size):
    keys = ["a", "a", "a", None, None, "b", "c", "c", "c", "c", "c", "c", "d"]
    table = pa.table({"k": keys, "j": [1, 1, 2, 2, None, None, 1, 1, 1, 1, 1, 1, 1], "v": range(13)})
    batches = [b for i in range(0, 13, size) for b in table.slice(i, size).combine_chunks().to_batches()]
    got = [(t.column("k")[0].as_py(), t.column("j")[0].as_py(), t.column("v").to_pylist()) for t in whole_groups(iter([batches[0].slice(0, 0), *batches]), ["k", "j"])]
    assert got == [("a", 1, [0, 1]), ("a", 2, [2]), (None, 2, [3]), (None, None, [4]), ("b", None, [5]), ("c", 1, [6, 7, 8, 9, 10, 11]), ("d", 1, [12])]
    assert list(whole_groups(iter([]), ["k"])) == [] and group_ends([pa.array([1])]).tolist() == []


def test_a_group_larger_than_a_batch(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        rows = spark.range(1000).selectExpr("id", "if(id % 3 = 0, 0, id % 50) as k")
        kernel = lambda t: pa.table({"k": t.column("k").slice(0, 1), "n": [t.num_rows], "sorted": [t.column("id").to_pylist() == sorted(t.column("id").to_pylist())]})
        got = map_groups(rows, ["k"], ["id"], kernel, "k long, n long, sorted boolean")
        want = rows.groupBy("k").count()
        assert sorted((r.k, r.n) for r in got.collect()) == sorted(map(tuple, want.collect())) and all(r.sorted for r in got.collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
