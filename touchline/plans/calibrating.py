"""Registered queries of calibration, and their SQL."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from touchline.operators import calibration
from touchline.plans.base import query
from touchline.sources.shared import staged, table


def scored(spark, d):
    """Events with a score and a label that leans on it."""
    return table(spark, d, "events").select("event_id", "user_id", "event_type", (F.floor("value") / 100).alias("score"), (((F.col("event_id") * 7919) % 100) < F.col("value")).cast("int").alias("label"))


ROWS = "r AS (SELECT event_id, user_id, event_type, floor(value) / 100 AS score, ((event_id * 7919) % 100 < value)::INTEGER AS label FROM events WHERE value IS NOT NULL)"
#: The least rising fit as a formula: the greatest over starts of the least mean over ends.
FIT = """
    c AS (SELECT score, count(*) AS n, sum(label) AS p FROM r GROUP BY 1), s AS (SELECT score, n, p, sum(n) OVER o AS cn, sum(p) OVER o AS cp, row_number() OVER o AS i FROM c WINDOW o AS (ORDER BY score)),
    m AS (SELECT a.i AS a, b.i AS b, (b.cp - a.cp + a.p) / (b.cn - a.cn + a.n)::DOUBLE AS mean FROM s a JOIN s b ON a.i <= b.i),
    v AS (SELECT score, n, p, max(least_) AS value FROM (SELECT s.score, s.n, s.p, m.a, min(m.mean) AS least_ FROM s JOIN m ON m.a <= s.i AND m.b >= s.i GROUP BY ALL) GROUP BY ALL)
"""


@query(f"WITH {ROWS}, {FIT} SELECT min(score) AS low, max(score) AS high, sum(n)::BIGINT AS n, sum(p)::BIGINT AS positives, round(value, 9) AS value FROM v GROUP BY round(value, 9)")
def d15_isotonic(spark, d):
    """The isotonic fit of the labels on the scores, as blocks."""
    return calibration.isotonic(scored(spark, d), staged).withColumn("value", F.round("value", 9))


@query(f"""
    WITH {ROWS}, c AS (SELECT event_type, score, sum(label) AS p, sum(1 - label) AS n FROM r GROUP BY 1, 2),
    s AS (SELECT event_type, p, n, sum(n) OVER (PARTITION BY event_type ORDER BY score) - n / 2 AS below FROM c)
    SELECT event_type, round(sum(p * below) / nullif(sum(p) * sum(n), 0), 9)::DOUBLE AS auc FROM s GROUP BY 1
""")
def d15_areas(spark, d):
    """The area under the curve by kind of event."""
    return calibration.areas(scored(spark, d), ["event_type"]).withColumn("auc", F.round("auc", 9))


def _poisson(u: str) -> str:
    below = [sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) for k in range(12)]
    return "CASE " + " ".join(f"WHEN {u} < {b!r}::DOUBLE THEN {k}" for k, b in enumerate(below)) + " ELSE 12 END"


@query(f"""
    WITH {ROWS}, w AS (SELECT k AS replicate, score, label, ('0x' || substr(md5(event_id || '|7|' || k), 1, 8))::BIGINT / 4294967296::DOUBLE AS u FROM r, range(40) t(k)),
    x AS (SELECT replicate, score, label, {_poisson('u')} AS n FROM w), c AS (SELECT replicate, score, sum(n * label) AS p, sum(n * (1 - label)) AS n FROM x GROUP BY 1, 2),
    s AS (SELECT replicate, p, n, sum(n) OVER (PARTITION BY replicate ORDER BY score) - n / 2 AS below FROM c),
    b AS (SELECT replicate, sum(p * below) / (sum(p) * sum(n)) AS auc FROM s GROUP BY 1),
    y AS (SELECT score, sum(label) AS p, sum(1 - label) AS n FROM r GROUP BY 1), z AS (SELECT p, n, sum(n) OVER (ORDER BY score) - n / 2 AS below FROM y)
    SELECT round((SELECT sum(p * below) / (sum(p) * sum(n)) FROM z), 9)::DOUBLE AS auc, round(quantile_cont(auc, 0.025), 9)::DOUBLE AS low, round(quantile_cont(auc, 0.975), 9)::DOUBLE AS high FROM b
""")
def d15_area_interval(spark, d):
    """The area under the curve of all events with its bootstrap interval from 40 resamplings."""
    out = calibration.area_interval(scored(spark, d), "event_id", replicates=40, seed=7)
    return out.select(*(F.round(c, 9).alias(c) for c in out.columns))


@query(None)
def d15_cross_validated(spark, d):
    """Calibrated shares fitted without a user's own fold, five folds of users."""
    out = calibration.cross_validated(scored(spark, d).where("score is not null"), F.col("user_id"), 5, staged)
    return out.select("event_id", "fold", F.round("calibrated", 9).alias("calibrated"))
