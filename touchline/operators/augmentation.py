"""Variants of rows with places: mirrored, sides swapped, and shifted by small amounts that follow from the rows alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def noise(key: Column, seed: int, name: str) -> Column:
    """A number from -1 up to 1 that follows from the key, the seed and the name: reruns and other partitions give the same."""
    digest = F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed)), F.lit(name)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / 2**31 - 1


def augmented(rows: DataFrame, key: str, side: str, length: float = 120.0, width: float = 80.0, shift: float = 0.5, seed: int = 1) -> DataFrame:
    """Each row four times: ``variant`` is ``as_is``, ``mirrored`` (across the pitch), ``swapped`` (the other side 0 or 1, playing the other way) and ``shifted``
    (by at most ``shift``, staying in the pitch). ``rows`` has ``x, y`` and the side; nulls stay null. No shuffle: a row makes its own variants."""
    x, y, s = F.col("x"), F.col("y"), F.col(side)
    inside = lambda v, most: F.when(v.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(most), v)))
    variant = lambda name, x, y, s: F.struct(F.lit(name).alias("variant"), x.cast("double").alias("x"), y.cast("double").alias("y"), s.cast("int").alias("s"))
    moved = [inside(v + shift * noise(F.col(key), seed, n), most) for v, n, most in ((x, "x", length), (y, "y", width))]
    every = F.array(variant("as_is", x, y, s), variant("mirrored", x, width - y, s), variant("swapped", length - x, width - y, 1 - s), variant("shifted", *moved, s))
    kept = [c for c in rows.columns if c not in ("x", "y", side)]
    return rows.select(*kept, F.explode(every).alias("v")).select(*kept, "v.variant", "v.x", "v.y", F.col("v.s").alias(side))
