"""Drift between two samples of one column: population stability, Kolmogorov-Smirnov distance, cumulative sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def stability_index(rows: DataFrame, by: list[str], value: str, is_new: Column, bins: int = 10, extra: float = 1e-6) -> DataFrame:
    """Per ``by``: ``psi``, the sum over bins of (new share - old share) * ln(new share / old share), 0 at least.

    ``bins`` bins of equal width lie from the least to the greatest old value (half a unit to both sides of a single one); ``extra`` is added to each share. New values
    outside count in the number of all only. Null values don't count; a group without old or new values has null. Two partial aggregates: no task gathers a group."""
    rows = rows.where(F.col(value).isNotNull()).withColumn("__new", is_new)
    old = F.when(~F.col("__new"), F.col(value))
    ends = rows.groupBy(*by).agg(F.min(old).alias("__low"), F.max(old).alias("__high"), F.count_if("__new").alias("__n"), F.count_if(~F.col("__new")).alias("__o"))
    flat = F.col("__low") == F.col("__high")
    ends = ends.select(*by, (F.col("__low") - F.when(flat, 0.5).otherwise(0.0)).alias("__low"), (F.col("__high") + F.when(flat, 0.5).otherwise(0.0)).alias("__high"), "__n", "__o")
    placed = rows.join(ends, by).where(F.col(value).between(F.col("__low"), F.col("__high")))
    bin_ = F.least(F.floor((F.col(value) - F.col("__low")) / (F.col("__high") - F.col("__low")) * bins), F.lit(bins - 1))
    counts = placed.withColumn("__bin", bin_).groupBy(*by, "__bin").agg(F.count_if("__new").alias("n"), F.count_if(~F.col("__new")).alias("o"))
    counts = counts.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("__bin", F.struct("n", "o").alias("c")))).alias("c"))  # ``bins`` at most
    share = lambda c, k, of: F.coalesce(F.try_element_at("c", k.cast("long"))[c], F.lit(0)) / F.col(of) + extra
    term = lambda k: (share("n", k, "__n") - share("o", k, "__o")) * F.log(share("n", k, "__n") / share("o", k, "__o"))
    psi = F.aggregate(F.sequence(F.lit(0), F.lit(bins - 1)), F.lit(0.0), lambda s, k: s + term(k))
    return ends.join(counts, by, "left").select(*by, F.when((F.col("__n") > 0) & (F.col("__o") > 0), F.greatest(psi, F.lit(0.0))).alias("psi"))


def ranged_sums(rows: DataFrame, by: list[str], value: str, width: float, counts: dict[str, Column]) -> DataFrame:
    """``*by, value``, the named counts of each value, their running sums ``below_*`` (this value included), totals ``all_*``, and ``after``, the next value.

    Values are counted in ranges of ``width``; sums run over the ranges' totals first and then inside a range, so no task gathers the values of a group."""
    ranged = rows.where(F.col(value).isNotNull()).withColumn("__range", F.floor(F.col(value) / width))
    own = ranged.groupBy(*by, "__range", value).agg(*(c.alias(k) for k, c in counts.items()))
    totals = own.groupBy(*by, "__range").agg(*(F.sum(k).alias(f"__{k}") for k in counts), F.min(value).alias("__first"))
    whole, ordered = Window.partitionBy(*by), Window.partitionBy(*by).orderBy("__range")
    totals = totals.select(*by, "__range", *((F.sum(f"__{k}").over(ordered) - F.col(f"__{k}")).alias(f"__before_{k}") for k in counts), *(F.sum(f"__{k}").over(whole).alias(f"all_{k}") for k in counts), F.lead("__first").over(ordered).alias("__next"))
    inside = Window.partitionBy(*by, "__range").orderBy(value)
    joined = own.join(totals, [*by, "__range"])
    return joined.select(*by, value, *counts, *((F.col(f"__before_{k}") + F.sum(k).over(inside)).alias(f"below_{k}") for k in counts), *(f"all_{k}" for k in counts), F.coalesce(F.lead(value).over(inside), "__next").alias("after"))


def _two(is_new: Column) -> dict[str, Column]:
    return {"new": F.count_if(is_new), "old": F.count_if(~is_new)}


def distribution_distance(rows: DataFrame, by: list[str], value: str, is_new: Column, width: float) -> DataFrame:
    """Per ``by``: ``ks``, the largest distance of the two empirical distributions (see ``ranged_sums``)."""
    sums = ranged_sums(rows, by, value, width, _two(is_new))
    return sums.groupBy(*by).agg(F.max(F.abs(F.col("below_new") / F.col("all_new") - F.col("below_old") / F.col("all_old"))).alias("ks"))


def transport_distance(rows: DataFrame, by: list[str], value: str, is_new: Column, width: float) -> DataFrame:
    """Per ``by``: ``wasserstein``, the area between the two empirical distributions (see ``ranged_sums``)."""
    sums = ranged_sums(rows, by, value, width, _two(is_new))
    area = F.abs(F.col("below_new") / F.col("all_new") - F.col("below_old") / F.col("all_old")) * (F.col("after") - F.col(value))
    return sums.groupBy(*by).agg(F.coalesce(F.sum(area), F.lit(0.0)).alias("wasserstein"))


def percentiles(rows: DataFrame, by: list[str], value: str, shares: dict[str, float], width: float) -> DataFrame:
    """``*by``, the named percentiles of the values, between two values in proportion, and ``n``, the number of values; exactly (see ``ranged_sums``)."""
    sums = ranged_sums(rows, by, value, width, {"n": F.count(F.lit(1))})

    def at(place: Column) -> Column:
        return F.max(F.when((F.col("below_n") - F.col("n") <= place) & (place < F.col("below_n")), F.col(value)))

    def between(share: float) -> Column:
        place = F.lit(share) * (F.col("all_n") - 1)
        low, high = at(F.floor(place)), at(F.ceil(place))
        return low + (high - low) * F.max(place - F.floor(place))

    return sums.groupBy(*by).agg(*(between(q).alias(k) for k, q in shares.items()), F.max("all_n").alias("n"))


def upper_cusum(rows: DataFrame, by: list[str], order: list[str], excess: Column, out: str = "cusum") -> DataFrame:
    """``rows`` with S = max(0, S before + excess): the running sum less its least value so far (0 included), in one window."""
    ordered = Window.partitionBy(*by).orderBy(*order)
    rows = rows.withColumn("__sum", F.sum(excess).over(ordered))
    return rows.withColumn(out, F.col("__sum") - F.least(F.min("__sum").over(ordered), F.lit(0))).drop("__sum")
