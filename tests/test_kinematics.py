"""Smoothing, halo windows and cumulative sums against plain loops."""

import random

import numpy as np
from pyspark.sql import functions as F

from touchline.operators.kinematics import halo_windows, smoothed
from touchline.operators.monitors import upper_cusum

SIZES = {"one": 1, "short": 6, "whole": 7, "long": 23}


def series():
    draw = random.Random(5)
    return {k: [round(draw.uniform(0, 100), 2) for _ in range(n)] for k, n in SIZES.items()}


def frame(spark):
    return spark.createDataFrame([(k, i, x) for k, xs in series().items() for i, x in enumerate(xs)], "k string, i int, x double")


def test_smoothed(spark):
    got = {(r.k, r.i): r.smoothed for r in smoothed(frame(spark), ["k"], ["i"], "x").collect()}
    for k, xs in series().items():
        for i, x in enumerate(xs):
            first = min(max(i - 3, 0), max(len(xs) - 7, 0))
            want = x if len(xs) < 7 else np.polyval(np.polyfit(range(7), xs[first : first + 7], 2), i - first)
            assert abs(got[k, i] - want) < 1e-6


def test_halo_windows(spark):
    got = sorted((r.k, r.window_no, r.i, r.is_halo) for r in halo_windows(frame(spark), ["k"], ["i"], 5, 2).collect())
    want = [(k, w, i, i // 5 != w) for k, n in SIZES.items() for w in range((n - 1) // 5 + 1) for i in range(max(0, 5 * w - 2), min(n, 5 * w + 7))]
    assert got == sorted(want)


def test_upper_cusum(spark):
    got = {(r.k, r.i): r.cusum for r in upper_cusum(frame(spark), ["k"], ["i"], F.col("x") - 45).collect()}
    for k, xs in series().items():
        s = 0.0
        for i, x in enumerate(xs):
            s = max(0.0, s + x - 45)
            assert abs(got[k, i] - s) < 1e-6


def test_empty(spark):
    none = frame(spark).where("false")
    assert smoothed(none, ["k"], ["i"], "x").count() == halo_windows(none, ["k"], ["i"], 5, 2).count() == upper_cusum(none, ["k"], ["i"], F.col("x")).count() == 0
