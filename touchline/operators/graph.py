"""Connected components of a link table, by Spark joins."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Links to a shuffle partition, and the fewest partitions of a round.
LINKS_TO_PARTITION, LEAST_PARTITIONS = 10_000, 16


@contextmanager
def sized_shuffles(spark: SparkSession, rows: int) -> Iterator[None]:
    """Plans made inside shuffle into as many partitions as ``rows`` asks for, never more than the session's setting."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, min(int(before), max(LEAST_PARTITIONS, -(-rows // LINKS_TO_PARTITION))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def connected_components(links: DataFrame, stage, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """``node, component``: the smallest node reachable over the links, for every node that has a link.

    Alternates large-star and small-star steps (Kiveris et al., 2014): every node's larger neighbours, then its
    smaller ones, are tied to its smallest neighbour. It needs about log(n) rounds, and no step gathers a neighbourhood:
    minima are taken by partial aggregates and joined back. ``stage`` writes a frame to shared storage and reads
    it back, which cuts the lineage between rounds. A round's shuffles follow the number of links left, so that few links
    do not cost the driver a task for each partition of the session. Null ends and self-links are ignored; repeated links count once.
    """
    edges = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null and a <> b")
    edges = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    # A star forest keeps its edges: then every node points to its component's smallest node.
    marks = lambda: tuple(edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40))).alias("h")).first())
    before = marks()
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b")))
        with sized_shuffles(edges.sparkSession, before[0]):
            edges = stage(small.where("a <> b").distinct(), "links")
        if (after := marks()) == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
