import math
import random

import numpy as np
import pytest
from touchline.operators import shapes, threat

ACTION = "g string, is_shot boolean, is_move boolean, success boolean, x double, y double, end_x double, end_y double"


def cell(x, y):
    xi, yj = min(max(int(x / 105 * 16), 0), 15), min(max(int(y / 68 * 12), 0), 11)
    return (11 - yj) * 16 + xi


def test_expected_threat(spark):
    rnd = random.Random(8)
    spot = lambda: (rnd.uniform(-2, 108), rnd.uniform(-2, 70))
    rows = []
    for _ in range(1500):
        shot = rnd.random() < 0.1
        end = (None, None) if rnd.random() < 0.05 or shot else spot()
        rows.append((rnd.choice("ab"), shot, not shot, rnd.random() < 0.7, *spot(), *end))
    rows += [("a", True, False, None, 100.0, 30.0, None, None), ("a", False, True, True, None, 3.0, 1.0, 1.0), ("a", False, False, True, 3.0, 3.0, 1.0, 1.0)]
    got = threat.expected_threat(spark.createDataFrame(rows, ACTION).repartition(3), ["g"]).collect()
    for g in "ab":
        own = [r for r in rows if r[0] == g and r[4] is not None]
        shots, moves = [r for r in own if r[1]], [r for r in own if r[2]]
        n = lambda rs: np.bincount([cell(r[4], r[5]) for r in rs], minlength=192).astype(float)
        ns, ng, nm, nt = n(shots), n([r for r in shots if r[3]]), n(moves), n([r for r in moves if r[6] is not None])
        ways = np.zeros((192, 192))
        for r in moves:
            if r[3] and r[6] is not None:
                ways[cell(r[4], r[5]), cell(r[6], r[7])] += 1
        with np.errstate(invalid="ignore", divide="ignore"):
            shot, move, ways = np.nan_to_num(ng / (ns + nm)), np.nan_to_num(nm / (ns + nm)), np.nan_to_num(ways / nt[:, None])
        want = np.linalg.solve(np.eye(192) - move[:, None] * ways, shot)  # what the rounds settle at
        value = {r.zone: r.value for r in got if r.g == g}
        assert len(value) == 192 and np.allclose([value[z] for z in range(192)], want, atol=1e-3)
    assert all(r.rounds > 3 for r in got)


def test_defensive_credits(spark):
    cols = "a long, action_type string, actor long, action_x double, action_y double, value double, d long, x double, y double"
    rows = [
        (1, "tackle", 7, 50.0, 34.0, 0.5, 7, 50.0, 34.0), (1, "tackle", 7, 50.0, 34.0, 0.5, 8, 53.0, 34.0), (1, "tackle", 7, 50.0, 34.0, 0.5, 9, 54.0, 34.0), (1, "tackle", 7, 50.0, 34.0, 0.5, 10, 90.0, 34.0),
        (2, "pass", 7, 50.0, 34.0, -0.5, 7, 60.0, 35.0), (2, "pass", 7, 50.0, 34.0, -0.5, 8, 60.0, 60.0), (2, "pass", 7, 50.0, 34.0, -0.5, 9, 50.0, 34.0),
        (3, "pass", 7, 50.0, 34.0, 0.0, 8, 60.0, 34.0), (4, "pass", 7, 50.0, 34.0, 1.0, 9, 52.0, 34.0), (4, "pass", 7, 50.0, 34.0, 1.0, 8, 48.0, 34.0), (5, "pass", None, None, 1.0, 1.0, 8, 1.0, 1.0),
    ]
    got = {(r.a, r.d): r.credit for r in threat.defensive_credits(spark.createDataFrame(rows, cols), "a", "d").collect()}
    assert got == {(1, 7): "intercept", (1, 8): "concede", (1, 9): "disturb", (2, 7): "deter", (2, 9): "disturb", (4, 8): "concede", (4, 9): "disturb"}


def test_team_shapes(spark):
    rnd = random.Random(4)
    frames = {k: [(rnd.uniform(0, 120), rnd.uniform(0, 80)) for _ in range(n)] for k, n in enumerate([10, 11, 3, 2, 0, 7])}
    frames[6] = [(float(i), 2.0 * i) for i in range(5)]
    frames[7] = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0), (5.0, 5.0), (5.0, 0.0)]
    rows = spark.createDataFrame([(k, [p[0] for p in t], [p[1] for p in t]) for k, t in frames.items()], "frame int, xs array<double>, ys array<double>")
    got = {r.frame: r for r in shapes.team_shapes(rows, ["frame"]).collect()}
    assert got[3].stretch is None and got[4].players == 0 and got[4].line_gaps is None
    assert got[6].hull_area == pytest.approx(0, abs=1e-9) and got[7].hull_area == pytest.approx(100)
    for k in (0, 1, 2, 5):
        p, r = frames[k], got[k]
        cx, cy = sum(x for x, _ in p) / len(p), sum(y for _, y in p) / len(p)
        assert (r.centre_x, r.centre_y, r.length) == pytest.approx((cx, cy, max(x for x, _ in p) - min(x for x, _ in p)))
        assert r.stretch == pytest.approx(sum(math.dist(q, (cx, cy)) for q in p) / len(p))
        tri = shapes.triangles(np.array([p]))[0].tolist()  # the triangles fill the hull
        area = sum(abs((p[b][0] - p[a][0]) * (p[c][1] - p[a][1]) - (p[b][1] - p[a][1]) * (p[c][0] - p[a][0])) / 2 for a, b, c in tri)
        assert r.hull_area == pytest.approx(area) and len(r.line_gaps) == 2 and min(r.line_gaps) >= 0
        assert min(x for x, _ in p) <= r.line_height <= cx
