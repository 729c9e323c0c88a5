"""Sums and next rows over ranges of a group give what the whole group would."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from touchline.operators.augmentation import augmented
from touchline.operators.monitors import percentiles
from touchline.operators.temporal import lead_in_parts


@pytest.mark.parametrize("width", [0.5, 7.0, 1000.0])
def test_percentiles(spark, width):
    rnd = random.Random(3)
    rows = [("a", round(rnd.gauss(10, 30), 1)) for _ in range(301)] + [("b", 4.0)] * 7 + [("c", -3.0), ("c", 8.0), ("c", None), ("d", None)]
    got = {r.g: r for r in percentiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", {"low": 0.0, "mid": 0.5, "most": 0.95, "top": 1.0}, width).collect()}
    assert set(got) == {"a", "b", "c"}
    for g, r in got.items():
        v = [x for k, x in rows if k == g and x is not None]
        assert (r.low, r.mid, r.most, r.top) == pytest.approx(tuple(np.quantile(v, q) for q in (0, 0.5, 0.95, 1))) and r.n == len(v)


@pytest.mark.parametrize("size", [1, 4, 100])
def test_next_rows_cross_parts(spark, size):
    rows = [("a", t, i) for i, t in enumerate([0, 1, 1, 2, 9, 17, 18, 40])] + [("b", 5, 50)]
    df = lead_in_parts(spark.createDataFrame(rows, "g string, t int, v int"), ["g"], F.floor(F.col("t") / size), ["t", "v"], {"v": "after"})
    assert {r.v: r.after for r in df.collect()} == {**{i: i + 1 for i in range(7)}, 7: None, 50: None}
    assert df.columns == ["g", "t", "v", "after"]


def test_variants(spark):
    rows = spark.createDataFrame([(1, 119.9, 10.0, 0), (2, None, 5.0, 1)], "id long, x double, y double, side int")
    got = {(r.id, r.variant): (r.x, r.y, r.side) for r in augmented(rows, "id", "side").collect()}
    assert got[1, "as_is"] == (119.9, 10.0, 0) and got[1, "mirrored"] == (119.9, 70.0, 0)
    assert got[1, "swapped"] == (pytest.approx(0.1), 70.0, 1) and got[2, "swapped"] == (None, 75.0, 0)
    x, y, _ = got[1, "shifted"]
    assert 119.4 <= x <= 120 and abs(y - 10) <= 0.5 and got[2, "shifted"][0] is None
    again = {(r.id, r.variant): (r.x, r.y, r.side) for r in augmented(rows.repartition(3), "id", "side").collect()}
    assert again == got
