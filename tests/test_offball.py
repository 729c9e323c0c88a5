import math
import random

import numpy as np
import pytest
from touchline.operators import offball

PLAYER = "struct<home:boolean,x:double,y:double,vx:double,vy:double>"


def control(players, x, y, dt):
    """The home side's control of a place, player by player."""
    times = {True: [], False: []}
    for home, px, py, vx, vy in players:
        px, py = min(max(px + vx * dt, 0), 120) * 105 / 120, min(max(py + vy * dt, 0), 80) * 68 / 80
        dx, dy = x * 105 / 120 - px, y * 68 / 80 - py
        d = math.hypot(dx, dy)
        along = (vx * 105 / 120 * dx + vy * 68 / 80 * dy) / d if d else 0.0
        times[home].append(max(0.7, 0.7 + (math.sqrt(along**2 + 14 * d) - along) / 7))
    if not times[True] or not times[False]:
        return 1.0 if times[True] else 0.0 if times[False] else 0.5
    total = {s: sum(1 / (1 + math.exp(min(max(-math.pi / (math.sqrt(3) * 0.45) * (min(times[not s]) - t), -50), 50))) for t in times[s]) for s in (True, False)}
    whole = total[True] + total[False]
    return total[True] / whole if whole > 1e-10 else 0.5


def worth(home, players, x, y, dt):
    u, v = (math.floor(min(max(p / m * (n - 1), 0), n - 1)) / (n - 1) for p, m, n in ((x, 120, 104), (y, 80, 68)))
    c = control(players, x, y, dt)
    return (c if home else 1 - c) * math.exp(-((u - 0.5) ** 2 + (v - 0.5) ** 2) / 0.18) * (0.01 + 0.29 * u)


def test_pass_values(spark):
    rnd = random.Random(5)
    player = lambda: (rnd.random() < 0.5, rnd.uniform(0, 120), rnd.uniform(0, 80), rnd.uniform(-5, 5), rnd.uniform(-5, 5))
    rows = []
    for i in range(60):
        players = [player() for _ in range(rnd.choice([0, 1, 5, 22]))]
        mates = [(rnd.uniform(0, 120), rnd.uniform(0, 80)) for _ in range(rnd.choice([0, 3, 10]))]
        rows.append((i, rnd.random() < 0.5, rnd.uniform(-3, 130), rnd.uniform(0, 80), players, mates))
    rows += [(60, True, None, 5.0, [player()], []), (61, True, 5.0, 5.0, None, None), (62, True, 30.0, 30.0, [(False, 30.0, 30.0, 0.0, 0.0)], [])]
    got = {r.id: r for r in offball.pass_values(spark.createDataFrame(rows, f"id long, home boolean, end_x double, end_y double, players array<{PLAYER}>, mates array<struct<x:double,y:double>>").repartition(2), "id", rate=2.0).collect()}
    for i, home, x, y, players, mates in rows:
        r = got[i]
        if x is None:
            assert (r.actual, r.peak, r.optimal, r.timing, r.aim, r.score) == (None,) * 6
            continue
        actual = worth(home, players or [], x, y, 0)
        peak = max(worth(home, players or [], x, y, k / 2) for k in range(-6, 3))
        optimal = max([actual] + [worth(home, players or [], *m, 0) for m in mates or []])
        assert (r.actual, r.peak, r.optimal) == pytest.approx((actual, peak, optimal))
        assert r.score == pytest.approx((actual / peak if peak else 0) * (actual / optimal if optimal else 0))
    assert (got[62].actual, got[62].timing, got[62].aim, got[62].score) == (0, 0, 0, 0)  # the other side has all control


def test_surface(spark):
    rows = [(f, x, y, c, bx, 40.0) for f, bx in ((1, 60.0), (2, 1e6)) for x, y, c in ((0.0, 0.0, 0.5), (60.0, 40.0, 1.0), (120.0, 80.0, 0.2))] + [(3, 1.0, 1.0, None, 1.0, 1.0)]
    got = offball.off_ball_value(spark.createDataFrame(rows, "f int, x double, y double, control double, ball_x double, ball_y double"), ["f"]).collect()
    value = {(r.f, r.x): r.off_ball_value for r in got}
    reach = lambda x, y: math.exp(-((x / 120 - 0.5) ** 2 + (y / 80 - 0.5) ** 2) / 0.18) * math.exp(-((x - 60) ** 2) / 1800 - (y - 40) ** 2 / 800)
    assert value[1, 60.0] == pytest.approx(1.0 * 1.0 * 0.155) and value[1, 120.0] == pytest.approx(0.2 * reach(120, 80) * 0.3)
    assert value[2, 60.0] == 0.0 and value[3, 1.0] is None  # nothing is in reach of a ball that far off
    assert np.isfinite([v for v in value.values() if v is not None]).all()
