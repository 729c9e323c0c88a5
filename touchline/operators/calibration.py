"""Calibration of scores: isotonic fits pooled over partitions, Platt's logistic fit, grouped cross-validation, and the area under the
curve with a bootstrap interval. Rows are ``score`` (double) and ``label`` (boolean or 0/1); rows without one of them don't count."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Stage = Callable[[DataFrame, str], DataFrame]
#: Blocks an isotonic fit may have to be broadcast: whole counts of n rows give no more than about n ** (2 / 3) of them.
MOST_BLOCKS = 2_000_000
#: Ranges of scores whose totals are summed up first.
RANGES = 1024
BLOCK = "low double, high double, n long, positives long"


def score_counts(rows: DataFrame, by: list[str] | None = None, weight: Column | None = None) -> DataFrame:
    """``*by, score, n, positives`` by distinct score."""
    label, w = F.col("label").cast("int"), F.lit(1) if weight is None else weight
    own = rows.where("score is not null and label is not null").withColumn("__w", w.cast("long"))
    return own.groupBy(*(by or []), F.col("score").cast("double").alias("score")).agg(F.sum("__w").alias("n"), F.sum(F.col("__w") * label).alias("positives"))


def pooled(blocks: list[tuple[float, float, int, int]]) -> list[tuple[float, float, int, int]]:
    """Blocks (low, high, n, positives) in order, neighbours merged until shares rise strictly. Pooling parts first gives the same."""
    out: list[tuple[float, float, int, int]] = []
    for low, high, n, positives in blocks:
        while out and out[-1][3] * n >= positives * out[-1][2]:  # the share before is not less: whole numbers, exactly
            low, n, positives = out[-1][0], n + out[-1][2], positives + out[-1][3]
            out.pop()
        out.append((low, high, n, positives))
    return out


def _pool(batches):
    """A partition's sorted blocks, pooled; what is held are blocks that rise."""
    held: list[tuple[float, float, int, int]] = []
    for batch in batches:
        held = pooled(held + list(zip(*(batch.column(c).to_pylist() for c in ("low", "high", "n", "positives")), strict=True)))
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*held, strict=True), (pa.float64(), pa.float64(), pa.int64(), pa.int64()), strict=True)], names=["low", "high", "n", "positives"])


def isotonic(rows: DataFrame, stage: Stage) -> DataFrame:
    """``low, high, n, positives, value``: the rising step function nearest to the labels; a row is a range of scores with one share.

    Scores are counted, dealt out by range and pooled in every partition; only the blocks that rise there go to the last task, which pools
    them across partitions. Pooling is the same in any grouping of neighbours, so this is the fit over all rows."""
    counts = score_counts(rows).where("n > 0").select(F.col("score").alias("low"), F.col("score").alias("high"), "n", "positives")
    parts = stage(counts.repartitionByRange("low").sortWithinPartitions("low").mapInArrow(_pool, BLOCK), "pooled-blocks")
    whole = parts.coalesce(1).sortWithinPartitions("low").mapInArrow(_pool, BLOCK)
    return stage(whole.withColumn("value", F.col("positives") / F.col("n")), "isotonic-blocks")


def calibrated(rows: DataFrame, blocks: DataFrame, score: str = "score", out: str = "calibrated") -> DataFrame:
    """``rows`` with the fitted share of their score: that of its block, between two blocks in proportion, beyond the ends that of the last."""
    if (n := blocks.count()) > MOST_BLOCKS:
        raise ValueError(f"{n} blocks: too many to broadcast")
    fit = blocks.orderBy("low").select("low", "high", "value").toPandas()  # bounded by MOST_BLOCKS
    x, y = np.ravel(fit[["low", "high"]].to_numpy(float)), np.repeat(fit["value"].to_numpy(float), 2)

    @F.pandas_udf("double")
    def value(s: pd.Series) -> pd.Series:
        return pd.Series(np.interp(s.to_numpy(float), x, y)).where(s.notna().to_numpy()) if len(x) else pd.Series(np.full(len(s), np.nan))

    return rows.withColumn(out, value(F.col(score).cast("double")))


def platt(rows: DataFrame, rounds: int = 50, close: float = 1e-10) -> tuple[float, float]:
    """(slope, intercept) of the logistic fit of the labels on the scores, with Platt's targets; by Newton steps, a sum over the counts each."""
    counts = score_counts(rows).cache()
    try:
        n, positives = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("positives"), F.lit(0))).first()
        high, low = (positives + 1) / (positives + 2), 1 / (n - positives + 2)
        a, b = 0.0, math.log((positives + 1) / (n - positives + 1))
        for _ in range(rounds):
            p = 1 / (1 + F.exp(-(F.lit(a) * F.col("score") + F.lit(b))))
            gap = F.col("positives") * high + (F.col("n") - F.col("positives")) * low - F.col("n") * p
            w, s = F.col("n") * p * (1 - p), F.col("score")
            ga, gb, haa, hab, hbb = (float(x or 0) for x in counts.agg(F.sum(gap * s), F.sum(gap), F.sum(w * s * s), F.sum(w * s), F.sum(w)).first())
            det = haa * hbb - hab * hab
            if det <= 1e-12 * max(haa * hbb, 1e-300):
                break
            da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
            a, b = a + da, b + db
            if abs(da) + abs(db) < close:
                break
    finally:
        counts.unpersist()
    return a, b


def fold_of(group: Column, folds: int) -> Column:
    """The fold of a row: all rows of a group are in one. Null groups are one group."""
    return F.pmod(F.conv(F.substring(F.md5(F.coalesce(group.cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long"), F.lit(folds)).cast("int")


def cross_validated(rows: DataFrame, group: Column, folds: int, stage: Stage) -> DataFrame:
    """``rows`` with ``fold`` and ``calibrated``, the isotonic share of each row's score fitted without its fold's groups."""
    rows, out = stage(rows.withColumn("fold", fold_of(group, folds)), "folds"), None
    for k in range(folds):
        own = calibrated(rows.where(F.col("fold") == k), isotonic(rows.where(F.col("fold") != k), stage))
        out = own if out is None else out.unionByName(own)
    return out


def areas(rows: DataFrame, by: list[str], weight: Column | None = None) -> DataFrame:
    """``*by, auc``: the share of (positive, negative) pairs in which the positive has the higher score, equal scores as half.

    Scores are counted, then summed up by range and inside a range: no task gathers the scores of a group, if they spread over ``RANGES``
    equal ranges between the least and the greatest. Null where a group has no positives or no negatives."""
    counts = score_counts(rows, by, weight).where("n > 0").withColumn("negatives", F.col("n") - F.col("positives"))
    ends = rows.where("score is not null").agg(F.min("score").cast("double").alias("least"), F.max("score").cast("double").alias("most"))
    low, high = (x or 0.0 for x in ends.first())
    ranged = counts.withColumn("__range", F.floor((F.col("score") - F.lit(low)) / F.lit((high - low) or 1.0) * RANGES))
    totals = ranged.groupBy(*by, "__range").agg(F.sum("negatives").alias("__own"))
    ordered = Window.partitionBy(*by).orderBy("__range") if by else Window.orderBy("__range")  # RANGES + 1 rows a group
    totals = totals.select(*by, "__range", (F.sum("__own").over(ordered) - F.col("__own")).alias("__below"))
    inside = Window.partitionBy(*by, "__range").orderBy("score")
    pairs = ranged.join(totals, [*by, "__range"]).withColumn("__wins", F.col("positives") * (F.col("__below") + F.sum("negatives").over(inside) - F.col("negatives") / 2))
    sums = pairs.groupBy(*by) if by else pairs.groupBy()
    return sums.agg(F.try_divide(F.sum("__wins"), F.sum("positives").cast("double") * F.sum("negatives").cast("double")).alias("auc"))


def poisson_weight(u: Column, most: int = 12) -> Column:
    """How often a row is drawn, Poisson with mean 1, from a uniform number below 1."""
    ladder, below = None, 0.0
    for k in range(most):
        below += math.exp(-1) / math.factorial(k)
        ladder = F.when(u < below, k) if ladder is None else ladder.when(u < below, k)
    return ladder.otherwise(most)


def bootstrap_areas(rows: DataFrame, id_col: str, replicates: int, seed: int) -> DataFrame:
    """``replicate, auc`` of resamplings of the rows. How often a row is in one follows from its id, the seed and the number of the
    replicate alone, whatever the partitions: reruns agree."""
    drawn = rows.withColumn("replicate", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))))
    text = F.concat_ws("|", F.col(id_col).cast("string"), F.lit(str(seed)), F.col("replicate").cast("string"))
    u = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / 2**32
    drawn = drawn.withColumn("__drawn", poisson_weight(u)).where("__drawn > 0")
    return areas(drawn, ["replicate"], F.col("__drawn"))


def area_interval(rows: DataFrame, id_col: str, replicates: int = 200, seed: int = 1, level: float = 0.95) -> DataFrame:
    """One row ``auc, low, high``: the area and the percentiles of its bootstrap values (``replicates`` numbers)."""
    ends = bootstrap_areas(rows, id_col, replicates, seed).agg(F.percentile("auc", (1 - level) / 2).alias("low"), F.percentile("auc", (1 + level) / 2).alias("high"))
    return areas(rows, []).withColumn("__k", F.lit(1)).join(ends.withColumn("__k", F.lit(1)), "__k").select("auc", "low", "high")
