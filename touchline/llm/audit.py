"""Audit of how quality filters interact: which documents a filter removes after which others.

Texts are scanned in Arrow tasks, a slice of the buffer at a time: NumPy finds the class of every byte, prefix sums count
words, capitals, characters and symbols of each text. Words are hashed by one prefix sum of the bytes times powers of an odd number:
a word's hash is the difference at its two ends over the power at its start. The hashes are sorted within each document, and
neighbours with one hash are compared byte by byte, so that distinct words are counted exactly. A document's failures are five bits; all orders of the filters are worked
out from the counts of documents by part and bits.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.bytescan import CAPITAL, CLASSES, CONTINUED, SPACE, SYMBOL, per_text, text_bytes, word_bounds
from touchline.llm.common import BROADCAST_ROWS, arrow_task, clean_texts, dropped, slices, small, staged

#: The filters, by bit.
FILTERS = "ABCDE"
#: An odd number and its inverse modulo 2 ** 64: its powers weigh the bytes of a word.
ODD = 0x9E3779B97F4A7C15
INVERSE = pow(ODD, -1, 1 << 64)
#: A group of equal texts with more rows than this and than a share of all is joined by broadcast: HOT_SHARE groups at most.
HOT_ROWS, HOT_SHARE = 2_000, 100_000


def word_hashes(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes from ``first`` up to ``last``."""
    with np.errstate(over="ignore"):
        powers = np.full(len(data) + 1, ODD, np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:-1])])
        back = np.full(len(data) + 1, INVERSE, np.uint64)
        back[0] = 1
        back = np.cumprod(back)
        return (sums[last] - sums[first]) * back[first]


def _unequal(data: np.ndarray, first: np.ndarray, length: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which of the pairs of words (i, j) differ in their bytes."""
    out = length[i] != length[j]
    same = np.flatnonzero(~out)
    n = length[i[same]]
    ends = np.cumsum(n)
    at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n, n)
    differ = data[np.repeat(first[i[same]], n) + at] != data[np.repeat(first[j[same]], n) + at]
    if len(same):
        out[same] = np.add.reduceat(differ.astype(np.int64), ends - n) > 0  # words have a byte at least
    return out


def distinct_words(data: np.ndarray, starts: np.ndarray, first: np.ndarray, last: np.ndarray, bits: int = 64) -> np.ndarray:
    """Distinct words of each text, exactly: hashes that meet by chance are told apart by the words themselves."""
    cuts = np.searchsorted(first, starts)
    doc = np.repeat(np.arange(len(starts) - 1), np.diff(cuts))
    h = word_hashes(data, first, last) >> np.uint64(64 - bits)
    order = np.lexsort((h, doc))
    again = np.flatnonzero((h[order[1:]] == h[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]]))
    i, j = order[again], order[again + 1]
    out = np.diff(cuts) - np.bincount(doc[i], minlength=len(starts) - 1)
    for d in np.unique(doc[i[_unequal(data, first, last - first, i, j)]]).tolist():
        out[d] = len(set(data[starts[d] : starts[d + 1]].tobytes().split()))
    return out


def _scan(bits: int):
    """Rows with a text to its counts."""
    kept = ["__id", "__part", "__digest"]

    def run(batches):
        for batch in batches:
            texts = clean_texts(batch.column("__text"))
            for i, j in slices(texts):
                data, starts = text_bytes(texts.slice(i, j - i))
                kind = CLASSES[data]
                first, last = word_bounds((kind & SPACE) > 0, starts)
                counts = [np.diff(np.searchsorted(first, starts)), distinct_words(data, starts, first, last, bits), per_text((kind & CONTINUED) == 0, starts), per_text((kind & CAPITAL) > 0, starts), per_text((kind & SYMBOL) > 0, starts)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, j - i) for c in kept), *(pa.array(c, pa.int64()) for c in counts)], names=[*kept, "words", "distinct", "chars", "capitals", "symbols"])

    return arrow_task(run)


def _with_first(rows: DataFrame) -> DataFrame:
    """``rows`` with ``__first``, the smallest id of the rows with the same text, where there are several."""
    groups = rows.groupBy("__digest").agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    groups = staged(groups.withColumnRenamed("__digest", "__of"), "equal-texts")
    same = F.col("__digest") == F.col("__of")
    if groups.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(groups.drop("n")), same, "left").drop("__of")
    # Rows of very large groups stay where they are, the others are dealt out by digest.
    large = F.col("n") > max(HOT_ROWS, rows.count() // HOT_SHARE)
    hot = staged(groups.where(large).drop("n"), "large-groups")
    rest = rows.join(F.broadcast(hot), same, "left_anti").join(groups.where(~large).drop("n"), same, "left")
    return rest.drop("__of").unionByName(rows.join(F.broadcast(hot), same).drop("__of"))


def filter_failures(docs: DataFrame, min_words: int = 200, distinct_percent: int = 50, capital_percent: int = 3, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", bits: int = 64) -> DataFrame:
    """The stored table ``__id, __part, words, distinct, chars, capitals, symbols, mask``, a row per row.

    Bits of ``mask``, from the lowest, are the failures A to E: under ``min_words`` words; distinct words below their share;
    capitals A-Z above theirs; any of ``#$%&*|``; a text that is also that of a smaller id. Null and empty texts have no
    words: they fail A, and E after the smallest of their ids. Rows without an id are no row's smaller one and never fail E,
    rows that share id and text do not fail it by each other. A null part is the empty one. ``bits`` are those of the words'
    hashes: fewer only leave more words to compare."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("__part"), F.unhex(F.sha2(text, 256)).alias("__digest"), text.alias("__text"))
    kind = own.schema["__id"].dataType.simpleString()
    rows = staged(own.mapInArrow(_scan(bits), f"__id {kind}, __part string, __digest binary, words long, distinct long, chars long, capitals long, symbols long"), "counts")
    fails = [
        F.col("words") < min_words,
        100 * F.col("distinct") < distinct_percent * F.col("words"),
        100 * F.col("capitals") > capital_percent * F.col("chars"),
        F.col("symbols") > 0,
        F.coalesce(F.col("__id") > F.col("__first"), F.lit(False)),
    ]
    mask = sum((F.when(f, 1 << bit).otherwise(0) for bit, f in enumerate(fails)), F.lit(0))
    out = staged(_with_first(rows).withColumn("mask", mask).drop("__digest", "__first"), "failures")
    dropped(rows)
    return out


def failure_counts(failures: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The stored table ``part, mask, n, good, toxic``: documents by part and failures, and those labelled good or toxic.

    A label counts if any row of the id in ``labels`` bears it; documents without labels are neither."""
    flag = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)))
    known = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__known")).agg(flag("quality").alias("good"), flag("toxic").alias("toxic"))
    known = staged(known.where("good or toxic"), "known-labels")
    joined = failures.select("__id", "__part", "mask").join(small(known), F.col("__id") == F.col("__known"), "left")
    count = lambda c: F.count(F.when(F.col(c), 1))
    return staged(joined.groupBy(F.col("__part").alias("part"), "mask").agg(F.count(F.lit(1)).alias("n"), count("good").alias("good"), count("toxic").alias("toxic")), "failure-counts")


def interactions(counts: DataFrame) -> DataFrame:
    """The effects of each filter at each step of each order, from ``part, mask, n, good, toxic``."""
    steps = [(("".join(order)), k + 1, 1 << FILTERS.index(order[k]), sum(1 << FILTERS.index(f) for f in order[:k])) for order in permutations(FILTERS) for k in range(len(order))]
    plan = F.array(*(F.struct(F.lit(o).alias("filter_order"), F.lit(k).alias("step"), F.lit(own).alias("own"), F.lit(before).alias("before")) for o, k, own, before in steps))
    # 600 steps for each part and mask: at most 32 rows a part.
    every = counts.select("part", "mask", "n", "good", "toxic", F.explode(plan).alias("s")).select("part", "mask", "n", "good", "toxic", "s.*")
    fails, gone = (F.col("mask").bitwiseAND(F.col(c)) > 0 for c in ("own", "before"))
    total = lambda when, of="n": F.coalesce(F.sum(F.when(when, F.col(of))), F.lit(0)).alias
    # Each of the failing filters comes first in an equal number of the orders.
    orders = F.expr(f"{len(steps) // len(FILTERS)} div bit_count(mask)")
    return every.groupBy("part", "filter_order", "step").agg(
        total(~gone & ~fails)("kept"),
        total(fails & ~gone)("removed"),
        total(fails & gone)("redundant"),
        total(F.col("mask") == F.col("own"))("unique_fails"),
        total(fails & ~gone, "good")("good_lost"),
        total(fails & ~gone, "toxic")("toxic_lost"),
        F.coalesce(F.sum(F.when(fails, F.col("n") * orders)), F.lit(0)).alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame, min_words: int = 200, distinct_percent: int = 50, capital_percent: int = 3, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """Per part, order of the filters A to E and step: ``kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``.

    ``kept`` is what is left after the step, ``removed`` what its filter removes there, ``redundant`` what fails its filter but
    was removed before, ``unique_fails`` what fails no other, ``good_lost`` and ``toxic_lost`` the removed with that label, and
    ``shapley`` the filter's removed, summed over all orders. An empty table has no parts. See ``filter_failures``."""
    failures = filter_failures(docs, min_words, distinct_percent, capital_percent, id_col, text_col, part_col)
    counts = failure_counts(failures, labels, id_col)
    dropped(failures)
    return interactions(counts)
