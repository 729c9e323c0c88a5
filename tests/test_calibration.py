import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from touchline.operators import calibration
from touchline.sources.shared import staged


def sample(n=600, seed=1):
    rnd = random.Random(seed)
    rows = [(i, i % 23, round(rnd.random(), 2), 0) for i in range(n)]
    return [(i, g, s, int(rnd.random() < s**2)) for i, g, s, _ in rows]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, g long, score double, label int").repartition(5)


def fit_by_formula(rows):
    """Share of each score as the greatest over starts of the least mean over ends."""
    scores = sorted({s for _, _, s, _ in rows})
    n = [sum(1 for r in rows if r[2] == s) for s in scores]
    p = [sum(r[3] for r in rows if r[2] == s) for s in scores]
    cn, cp = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(p)])
    mean = lambda a, b: (cp[b + 1] - cp[a]) / (cn[b + 1] - cn[a])
    return {s: max(min(mean(a, b) for b in range(i, len(scores))) for a in range(i + 1)) for i, s in enumerate(scores)}


def area_by_pairs(rows):
    wins = [1.0 if a[2] > b[2] else 0.5 if a[2] == b[2] else 0.0 for a in rows if a[3] for b in rows if not b[3]]
    return sum(wins) / len(wins) if wins else None


@pytest.mark.parametrize("parts", ["1", "4", "40"])
def test_isotonic_is_the_same_in_any_partitions(spark, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = sample()
        blocks = calibration.isotonic(frame(spark, rows + [(9999, 1, None, 1), (9998, 1, 0.5, None)]), staged).orderBy("low").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = fit_by_formula(rows)
    assert {s: next(b.value for b in blocks if b.low <= s <= b.high) for s in want} == pytest.approx(want)
    assert all(a.value < b.value and a.high < b.low for a, b in zip(blocks, blocks[1:], strict=False)) and sum(b.n for b in blocks) == len(rows)


def test_calibrated_between_and_beyond_blocks(spark):
    blocks = spark.createDataFrame([(0.2, 0.4, 0.1), (0.6, 0.6, 0.5)], "low double, high double, value double")
    got = calibration.calibrated(spark.createDataFrame([(0, 0.0), (1, 0.3), (2, 0.5), (3, 0.6), (4, 9.0), (5, None)], "i int, score double"), blocks).orderBy("i").collect()
    assert [None if r.calibrated is None else round(r.calibrated, 6) for r in got] == [0.1, 0.1, 0.3, 0.5, 0.5, None]


def test_areas(spark):
    rows = sample(200) + [(i + 500, 99, 0.5, 1) for i in range(5)]
    got = {r.g: r.auc for r in calibration.areas(frame(spark, rows), ["g"]).collect()}
    for g in {r[1] for r in rows}:
        want = area_by_pairs([r for r in rows if r[1] == g])
        assert got[g] == (None if want is None else pytest.approx(want))
    assert calibration.areas(frame(spark, rows), []).first()[0] == pytest.approx(area_by_pairs(rows))
    assert calibration.areas(frame(spark, []), []).first()[0] is None


def test_bootstrap_interval_holds_the_area_and_agrees_in_reruns(spark):
    rows = sample(500)
    a, b = (calibration.area_interval(frame(spark, rows).repartition(k), "id", replicates=60, seed=3).first() for k in (2, 7))
    assert tuple(a) == pytest.approx(tuple(b)) and a.low < a.auc < a.high
    error = math.sqrt(a.auc * (1 - a.auc) / sum(r[3] for r in rows))
    assert 0.3 * error < a.high - a.low < 8 * error
    weights = spark.range(1, 20001).select(calibration.poisson_weight((F.col("id") - 0.5) / 20000).alias("w")).agg(F.avg("w"), F.var_pop("w")).first()
    assert weights[0] == pytest.approx(1, abs=1e-3) and weights[1] == pytest.approx(1, abs=1e-2)


def test_platt_is_the_logistic_fit(spark):
    rows = sample(400)
    a, b = calibration.platt(frame(spark, rows))
    s, y = np.array([r[2] for r in rows]), np.array([r[3] for r in rows])
    t = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    p = 1 / (1 + np.exp(-(a * s + b)))
    assert abs((t - p).sum()) < 1e-6 and abs(((t - p) * s).sum()) < 1e-6  # the slope of the likelihood is 0
    assert calibration.platt(frame(spark, [(1, 1, 0.5, 1)] * 3))[1] > 0


def test_folds_keep_groups_together(spark):
    rows = sample(300)
    got = calibration.cross_validated(frame(spark, rows), F.col("g"), 3, staged).collect()
    fold = {}
    for r in got:
        assert fold.setdefault(r.g, r.fold) == r.fold
    assert len(got) == len(rows) and set(fold.values()) == {0, 1, 2}
    for k in range(3):
        fit = fit_by_formula([r for r in rows if fold[r[1]] != k])
        assert all(r.calibrated == pytest.approx(fit[r.score]) for r in got if r.fold == k and r.score in fit)
