"""Mixing of sources to target weights by thresholds on hashes.

Every row has a hash of 60 bits of its id and text. A mix takes of each source the rows whose hash is at most the source's
threshold, once more than the source's whole repeats: to find the threshold, sizes are summed by source and by the hash's
first bits; running sums over these buckets tell in which one the source's budget ends, and only the rows of that boundary
bucket are summed again by the next bits, until it holds one hash. Nothing is sorted but the buckets' sums. A mix with a
smaller budget has thresholds at most as high, or fewer repeats: mixes are nested.
"""

from __future__ import annotations

from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.bytescan import word_counts
from touchline.llm.common import arrow_task, clean_texts, dropped, slices, small, staged

#: Bits of a row's hash, and how many of them a histogram tells apart.
HASH_BITS, LEVEL_BITS = 60, 12


def _sized(batches):
    """Rows with a text to rows with its number of words."""
    for batch in batches:
        texts = clean_texts(batch.column("__text"))
        for i, j in slices(texts):
            yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, j - i) for c in ("__id", "__source", "__hash")), pa.array(word_counts(texts.slice(i, j - i)), pa.int64())], names=["__id", "__source", "__hash", "size"])


def sized_rows(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """The stored slim table ``__id, __source, __hash, size``: the only read of the texts."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit("|"), text))
    own = docs.select(F.col(id_col).alias("__id"), F.col(source_col).cast("string").alias("__source"), F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long").alias("__hash"), text.alias("__text"))
    kind = own.schema["__id"].dataType.simpleString()
    return staged(own.mapInArrow(arrow_task(_sized), f"__id {kind}, __source string, __hash long, size long"), "sizes")


def weighted_sources(rows: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """The stored table ``__source, total, weight``, a row per source. Sources by code point, null last, take the weights in turn.

    Places are counted in ranges of sources, so that many sources are not ordered by one task."""
    sources = rows.groupBy("__source").agg(F.sum("size").alias("total"))
    sources = staged(sources.repartitionByRange(F.col("__source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), "sources")
    parts = sources.groupBy("part").count()
    before = F.coalesce(F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", before.alias("before"))  # a row per partition
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.col("__source").asc_nulls_last())) - 1
    turn = F.pmod(F.col("before") + place, F.lit(len(weights))).cast("int") + 1
    out = staged(sources.join(F.broadcast(parts), "part").select("__source", "total", F.element_at(F.array(*map(F.lit, weights)), turn).cast("long").alias("weight")), "weights")
    dropped(sources)
    return out


def targets(sources: DataFrame, budget: int, most: int) -> DataFrame:
    """``sources`` with ``target``: shares of the budget by weight, at most ``most`` times a source's total, the excess shared again.

    Each round caps the sources above their bound and shares what is left; sums and comparisons are of whole numbers."""
    bound, exact = F.col("total") * most, "decimal(38,0)"
    capped = F.lit(False)
    while True:
        sums = sources.withColumn("capped", capped).agg(
            F.coalesce(F.sum(F.when(F.col("capped"), bound).cast(exact)), F.lit(0).cast(exact)).alias("held"),
            F.coalesce(F.sum(F.when(~F.col("capped"), F.col("weight")).cast(exact)), F.lit(0).cast(exact)).alias("weight"),
            F.count(F.when(F.col("capped"), 1)).alias("n"),
        ).first()
        left, weight = budget - int(sums.held), int(sums.weight)
        above = F.col("weight").cast(exact) * F.lit(Decimal(left)).cast(exact) > bound.cast(exact) * F.lit(Decimal(weight)).cast(exact)
        both = capped | above
        if not weight or sources.where(both).count() == sums.n:
            break
        capped = both
    level = F.col("weight").cast("double") * F.lit(float(left)) / F.lit(float(weight or 1))
    return sources.withColumn("target", F.when(capped, bound.cast("double")).otherwise(level))


def _cuts(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """``__source, mix, cut``: the highest hash that the source's rest budget takes; no row if it takes none.

    ``plans`` has ``__source, mix, need``, the words beyond whole repeats. The row on the budget's edge is taken if that
    brings the sum nearer."""
    edges = staged(plans.select("__source", "mix", "need", F.lit(0).cast("long").alias("prefix"), F.lit(0.0).alias("below")), "edges")
    inside, shift, found, used = rows, HASH_BITS, [], [edges]
    while shift > 0 and not (found and edges.isEmpty()):
        shift -= LEVEL_BITS
        if found:  # only the rows of the buckets on an edge are looked at again
            cells = staged(edges.select(F.col("__source").alias("s"), F.col("prefix").alias("p")).distinct(), "cells")
            same = F.col("__source").eqNullSafe(F.col("s")) & (F.shiftright("__hash", shift + LEVEL_BITS) == F.col("p"))
            inside = staged(inside.join(small(cells), same).select("__source", "__hash", "size"), "edge-rows")
            used += [cells, inside]
        sums = inside.groupBy(F.col("__source").alias("s"), F.shiftright("__hash", shift).alias("bucket")).agg(F.sum("size").alias("words"), F.min("__hash").alias("low"), F.max("__hash").alias("high"))
        own = sums.join(small(edges), F.col("__source").eqNullSafe(F.col("s")) & (F.shiftright("bucket", LEVEL_BITS) == F.col("prefix")))
        # At most 2 ** LEVEL_BITS buckets a source and mix.
        order = Window.partitionBy("__source", "mix").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        own = own.withColumn("run", F.col("below") + F.sum("words").over(order)).withColumn("start", F.col("run") - F.col("words"))
        fits = F.col("run") <= F.col("need")
        own = own.groupBy("__source", "mix", "need").agg(F.max(F.when(fits, F.col("high"))).alias("cut"), F.min(F.when(~fits, F.struct("bucket", "start", "words", "low", "high"))).alias("edge"))
        own = staged(own, "level")
        single = F.col("edge.low") == F.col("edge.high")
        found.append(own.select("__source", "mix", "cut"))
        found.append(own.where(single & (F.col("need") - F.col("edge.start") > F.col("edge.words") / 2)).select("__source", "mix", F.col("edge.high").alias("cut")))
        edges = staged(own.where(~single).select("__source", "mix", "need", F.col("edge.bucket").alias("prefix"), F.col("edge.start").alias("below")), "edges")
        used += [own, edges]
    cuts = found[0]
    for more in found[1:]:
        cuts = cuts.unionByName(more)
    out = staged(cuts.groupBy("__source", "mix").agg(F.max("cut").alias("cut")), "cuts")
    dropped(*used)
    return out


def nested_mixes(docs: DataFrame, shares: tuple[float, ...] = (1.0,), weights: tuple[int, ...] = (1, 2, 3), most: int = 3, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per row: ``id_col, size, source_size, mixes``; ``mixes`` has ``(target, taken)`` for each of ``shares`` of all words.

    ``size`` counts words, runs of characters other than ASCII white space; null and empty texts have none and are never
    taken. Sources, null as the last of them, take ``weights`` in turn in the order of their code points. A source's target
    is its share of the budget, at most ``most`` times its words. ``taken`` is ``size`` times the repeats of the row, at
    most ``most``. Rows alike in id and text have one hash: the threshold takes all of them or none. An empty table gives no
    rows. Other columns are not read."""
    rows = sized_rows(docs, id_col, text_col, source_col)
    sources = weighted_sources(rows, weights)
    total = int(sources.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0])
    aimed = None
    for mix, share in enumerate(shares):
        own = targets(sources, int(Decimal(share) * total), most).withColumn("mix", F.lit(mix))
        aimed = own if aimed is None else aimed.unionByName(own)
    repeats = F.when(F.col("total") > 0, F.floor(F.col("target") / F.col("total"))).otherwise(0).cast("long")
    aimed = staged(aimed.withColumn("repeats", repeats).withColumn("need", F.col("target") - F.col("repeats") * F.col("total")), "targets")
    cuts = _cuts(rows, aimed.select("__source", "mix", "need")).withColumnRenamed("__source", "s").withColumnRenamed("mix", "m")
    plan = aimed.join(cuts, F.col("__source").eqNullSafe(F.col("s")) & (F.col("mix") == F.col("m")), "left")
    plan = plan.groupBy(F.col("__source").alias("__of"), "total").agg(F.sort_array(F.collect_list(F.struct("mix", "target", "repeats", "cut"))).alias("plan"))
    plan = staged(plan, "plan")
    taken = F.transform("plan", lambda p: F.struct(p["target"].alias("target"), (F.col("size") * (p["repeats"] + F.coalesce((F.col("__hash") <= p["cut"]).cast("long"), F.lit(0)))).alias("taken")))
    joined = rows.join(small(plan), F.col("__source").eqNullSafe(F.col("__of")))
    return joined.select(F.col("__id").alias(id_col), "size", F.col("total").alias("source_size"), taken.alias("mixes"))


def mixed_sources(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per row: ``id_col, size, source_size, target, taken``, the mix of as many words as there are (see ``nested_mixes``)."""
    out = nested_mixes(docs, (1.0,), weights, most, id_col, text_col, source_col)
    return out.select(id_col, "size", "source_size", F.col("mixes")[0]["target"].alias("target"), F.col("mixes")[0]["taken"].alias("taken"))
