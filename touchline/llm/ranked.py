"""Ranked lexical search with a bit-sliced impact index.

1. Blocks. Tasks cut their documents into blocks and give each document of a block a slot, in the order of the ids. A block's
   row holds ids, lengths and the postings (term, slot, occurrences) of the terms that the items ask for.
2. Statistics over all blocks: documents and terms in all, and documents per term; they give every term's weight.
3. Index. A posting's impact is its whole contribution to a score, weight included. A term's impacts are stored by bit: slice
   ``b`` is a bitmap over the term's postings with the bit ``b`` of each.
4. Search. Slices are laid out over a block's slots. The impacts of an item's terms are added for all slots at once by
   carry-save adders on bitmaps, and one ripple of carries ends the sum. The top documents are found from the most significant slice
   downwards: documents with a bit set go before those without as long as they fit. Spark merges the blocks' tops.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.bytescan import text_bytes
from touchline.llm.common import arrow_task, ascii_lower, clean_texts, dropped, slice_words, slices, staged

#: Documents of a block (a slot has 16 bits), and postings at which a block ends before.
BLOCK_DOCS, BLOCK_POSTINGS = 1 << 14, 2_000_000
#: Terms of items, counted once an item, that one pass searches for: what the driver and every task hold of the items.
PASS_TERMS = 200_000
#: Terms whose laid-out slices a task keeps while it searches a block (70 KB each), and postings up to which they are set one by one.
KEPT_TERMS, FEW = 300, 64
#: Impacts without weight are below this.
SCALE = 1_000_000
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _folded() -> np.ndarray:
    """Bytes of terms, A-Z as a-z; other bytes become spaces."""
    out = np.full(256, 0x20, np.uint8)
    for low, high in ((0x30, 0x3A), (0x61, 0x7B), (0x80, 0x100)):
        out[low:high] = np.arange(low, high)
    out[0x41:0x5B] = np.arange(0x61, 0x7B)
    return out


FOLDED = _folded()


def term_texts(texts: pa.StringArray) -> pa.StringArray:
    """The texts with only their terms, in lower case (A-Z), between spaces."""
    data, starts = text_bytes(texts)
    return pa.StringArray.from_buffers(len(texts), pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(FOLDED[data]))


class _Block:
    """Documents and postings gathered for one row of the blocks' table."""

    def __init__(self):
        self.ids, self.n, self.slot, self.term, self.tf, self.docs, self.postings = [], [], [], [], [], 0, 0

    def add(self, ids: pa.Array, n: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray) -> None:
        for kept, more in ((self.ids, ids), (self.n, n), (self.slot, doc + self.docs), (self.term, term), (self.tf, tf)):
            kept.append(more)
        self.docs += len(ids)
        self.postings += len(doc)

    def row(self) -> pa.RecordBatch:
        ids = pa.concat_arrays(self.ids)
        order = pc.sort_indices(ids, null_placement="at_end").to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        slot, term, tf = place[np.concatenate(self.slot)], np.concatenate(self.term), np.concatenate(self.tf)
        by_term = np.lexsort((slot, term))
        terms, counts = np.unique(term, return_counts=True)
        lists = [ids.take(pa.array(order)), pa.array(np.concatenate(self.n)[order], pa.int64()), *(pa.array(x, pa.int32()) for x in (terms, counts, slot[by_term], tf[by_term]))]
        return pa.RecordBatch.from_arrays([_one_list(x) for x in lists], names=["ids", "n", "terms", "counts", "slots", "tfs"])


def _one_list(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _blocks(terms, block_docs: int):
    """Rows (id, text) to blocks; ``terms`` is a broadcast dictionary of the terms' numbers."""

    def run(batches):
        block = _Block()
        for batch in batches:
            texts = clean_texts(batch.column("__text"))
            for a, b in slices(texts):
                for i in range(a, b, block_docs):
                    own = texts.slice(i, min(block_docs, b - i))
                    words, codes, starts = slice_words(term_texts(own))
                    number = np.fromiter((terms.value.get(w, -1) for w in words), np.int64, len(words))[codes] if len(words) else np.zeros(0, np.int64)
                    doc = np.repeat(np.arange(len(own)), np.diff(starts))
                    asked = number >= 0
                    pair, tf = np.unique(doc[asked] << 32 | number[asked], return_counts=True)
                    if block.docs and (block.docs + len(own) > block_docs or block.postings + len(pair) > BLOCK_POSTINGS):
                        yield block.row()
                        block = _Block()
                    block.add(batch.column("__id").slice(i, len(own)), np.diff(starts), pair >> 32, pair & 0xFFFFFFFF, tf)
        if block.docs:
            yield block.row()

    return arrow_task(run)


def _sliced(weights, docs: int, words: int):
    """Blocks to the index: impacts of each term's postings by bit."""

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                of = lambda c: batch.column(c)[k].values.to_numpy().astype(np.int64)  # noqa: B023, E731
                n, terms, counts, slots, tf = map(of, ("n", "terms", "counts", "slots", "tfs"))
                m = 50 + 50 * n * docs // max(words, 1)
                impact = np.repeat(weights.value[terms], counts) * (1_000_000_000 * tf // (1000 * tf + 20 * m[slots]))
                ends = np.cumsum(counts)
                widths, bits = [], []
                for start, end in zip((ends - counts).tolist(), ends.tolist(), strict=True):
                    own = impact[start:end]
                    width = int(own.max()).bit_length()
                    widths.append(width)
                    bits.append(np.packbits((own >> np.arange(width)[:, None] & 1).astype(np.uint8), axis=1, bitorder="little").tobytes())
                kept = [batch.column(c).slice(k, 1) for c in ("ids", "terms", "counts", "slots")]
                yield pa.RecordBatch.from_arrays([*kept, _one_list(pa.array(widths, pa.int32())), pa.array([b"".join(bits)], pa.binary())], names=["ids", "terms", "counts", "slots", "widths", "bits"])

    return arrow_task(run)


def laid_out(bits: bytes, width: int, slots: np.ndarray, words: int) -> np.ndarray:
    """A term's slices as bitmaps over the slots of a block: ``width`` rows of ``words`` 64-bit words."""
    own = np.unpackbits(np.frombuffer(bits, np.uint8).reshape(width, -1), axis=1, count=len(slots), bitorder="little")
    if len(slots) <= FEW:
        out = np.zeros((width, words), np.uint64)
        row, at = np.nonzero(own)
        np.bitwise_or.at(out, (row, slots[at] >> 6), np.uint64(1) << (slots[at] & 63).astype(np.uint64))
        return out
    spread = np.zeros((width, words * 64), np.uint8)
    spread[:, slots] = own
    return np.packbits(spread, axis=1, bitorder="little").view(np.uint64)


def added(maps: list[np.ndarray], depth: int, words: int) -> np.ndarray:
    """The sums of bit-sliced numbers, by slice; ``depth`` bits hold every sum."""
    total, carry = np.zeros((depth, words), np.uint64), np.zeros((depth, words), np.uint64)
    for m in maps:
        w = len(m)
        half = total ^ carry
        over = total & carry
        over[:w] |= half[:w] & m
        half[:w] ^= m
        total = half
        carry[0] = 0
        carry[1:] = over[:-1]
    ripple = np.zeros(words, np.uint64)
    for b in range(depth):
        half = total[b] ^ carry[b]
        over = (total[b] & carry[b]) | (half & ripple)
        total[b] = half ^ ripple
        ripple = over
    return total


def _set_slots(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def top_slots(sums: np.ndarray, top: int) -> np.ndarray:
    """Slots of the ``top`` greatest sums above 0; of equal sums the lowest slots."""
    tied = np.bitwise_or.reduce(sums, axis=0)
    sure = np.zeros_like(tied)
    held = 0
    for row in sums[::-1]:
        more = tied & row
        n = int(np.bitwise_count(more).sum())
        if held + n > top:
            tied = more
        else:
            sure |= more
            tied &= ~row
            held += n
    return np.concatenate([_set_slots(sure), _set_slots(tied)[: top - held]])


def _search(items, depths: list[int], often: frozenset[int], top: int):
    """Index rows to ``item`` (number), ``__id, score``: each block's top, without what a task's earlier blocks have ruled out."""

    def run(batches):
        least: dict[int, np.ndarray] = {}
        for batch in batches:
            for k in range(batch.num_rows):
                ids = batch.column("ids")[k].values
                terms, counts, widths, slots = (batch.column(c)[k].values.to_numpy() for c in ("terms", "counts", "widths", "slots"))
                bits, words = batch.column("bits")[k].as_buffer(), -(-len(ids) // 64)
                ends = np.cumsum(counts, dtype=np.int64)
                bytes_ = np.cumsum(widths.astype(np.int64) * -(-counts // 8))
                at = {t: x for x, t in enumerate(terms.tolist())}
                kept: dict[int, np.ndarray] = {}

                def one(t):
                    if t in kept:  # noqa: B023
                        return kept[t]  # noqa: B023
                    x = at[t]  # noqa: B023
                    n = int(widths[x]) * -(-int(counts[x]) // 8)  # noqa: B023
                    out = laid_out(bits[int(bytes_[x]) - n : int(bytes_[x])], int(widths[x]), slots[ends[x] - counts[x] : ends[x]], words)  # noqa: B023
                    if t in often:
                        kept[t] = out  # noqa: B023
                    return out

                which, found, scores = [], [], []
                for q, own in enumerate(items.value):
                    there = [t for t in own if t in at and widths[at[t]]]
                    if not there:
                        continue
                    sums = added([one(t) for t in there], depths[q], words)
                    slot = top_slots(sums, top)
                    score = ((sums[:, slot >> 6] >> (slot & 63).astype(np.uint64) & np.uint64(1)) << np.arange(depths[q], dtype=np.uint64)[:, None]).sum(axis=0).astype(np.int64)
                    best = np.sort(np.concatenate([least.get(q, score[:0]), score]))[-top:]
                    least[q] = best
                    if len(best) == top:
                        slot, score = slot[score >= best[0]], score[score >= best[0]]
                    which.append(np.full(len(slot), q, np.int32))
                    found.append(slot)
                    scores.append(score)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(which)), ids.take(pa.array(np.concatenate(found))), pa.array(np.concatenate(scores))], names=["item", "__id", "score"])

    return arrow_task(run)


def _first_rows(rows: DataFrame, keys: list[str], order: list, most: int) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= most)


def impact_index(docs: DataFrame, terms: list[str], id_col: str = "doc_id", text_col: str = "text", block_docs: int = BLOCK_DOCS) -> tuple[DataFrame, dict[str, int]]:
    """The stored bit-sliced index of all rows for ``terms`` (``PASS_TERMS`` at most), and the weight of each term.

    A row of the index is a block: ``ids`` by slot, ``terms`` (numbers in the given list), ``counts`` and ``widths`` of the terms'
    slices, ``slots`` of their postings, and the slices' ``bits``. Texts are read once."""
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    kind = own.schema["__id"].dataType.simpleString()
    numbers = spark.sparkContext.broadcast({t.encode(): k for k, t in enumerate(terms)})
    blocks = staged(own.mapInArrow(_blocks(numbers, block_docs), f"ids array<{kind}>, n array<long>, terms array<int>, counts array<int>, slots array<int>, tfs array<int>"), "blocks")
    sums = blocks.agg(F.coalesce(F.sum(F.size(F.filter("n", lambda x: x > 0)).cast("long")), F.lit(0)).alias("docs"), F.coalesce(F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0)).alias("words")).first()
    seen = blocks.select(F.explode(F.arrays_zip("terms", "counts")).alias("t")).groupBy("t.terms").agg(F.sum("t.counts").alias("df"))
    weights = np.zeros(max(len(terms), 1), np.int64)
    for term, df in seen.toLocalIterator():  # a row for each of the terms at most
        weights[term] = math.floor(1000 * math.log((2 * sums.docs + 2) / (2 * df + 1)))
    held = spark.sparkContext.broadcast(weights)
    index = staged(blocks.mapInArrow(_sliced(held, sums.docs, sums.words), f"ids array<{kind}>, terms array<int>, counts array<int>, slots array<int>, widths array<int>, bits binary"), "impact-index")
    dropped(blocks)
    return index, dict(zip(terms, weights.tolist(), strict=False))


def search_index(index: DataFrame, items: list[list[int]], weights: list[int], top: int) -> DataFrame:
    """``item, rank, __id, score``: the ``top`` documents of each item, by place in ``items``; items are lists of numbers of terms."""
    spark = index.sparkSession
    depths = [max(1, sum(weights[t] * SCALE for t in own).bit_length()) for own in items]
    often = frozenset(t for t, n in Counter(t for own in items for t in own).most_common(KEPT_TERMS) if n > 1)
    kind = index.schema["ids"].dataType.elementType.simpleString()
    found = index.mapInArrow(_search(spark.sparkContext.broadcast(items), depths, often, top), f"item int, __id {kind}, score long")
    order = [F.col("score").desc(), F.col("__id").asc_nulls_last()]
    # A first round in parts of an item keeps the last one small, however many blocks there are.
    parts = found.withColumn("part", F.pmod(F.xxhash64("__id"), F.lit(64)))
    return _first_rows(_first_rows(parts, ["item", "part"], order, top).drop("part", "rank"), ["item"], order, top)


def ranked_search(docs: DataFrame, items: DataFrame, top: int = 50, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Per item its ``top`` documents with a score above 0: ``item_col, rank, id_col, score``, exactly.

    Terms are runs of ASCII letters (A-Z as a-z), digits and other characters than ASCII. Null and empty texts have no terms and count
    nowhere. Rows of one item id are one item with the terms of all; items without an id or terms find nothing. Rows of documents are
    ranked one by one, those that share an id too; equal scores by ascending id, rows without an id last. Items are searched for in passes
    of at most ``PASS_TERMS`` terms, an item with more in a pass of its own hash."""
    terms = F.regexp_extract_all(ascii_lower(F.coalesce(F.col(item_text).cast("string"), F.lit(""))), F.lit(TERM), 0)
    wanted = items.where(F.col(item_col).isNotNull()).select(F.col(item_col).alias("__item"), F.explode(F.array_distinct(terms)).alias("term"))
    wanted = staged(wanted.groupBy("__item").agg(F.sort_array(F.collect_set("term")).alias("terms")), "items")
    pairs = wanted.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    spark, passes, out = docs.sparkSession, max(1, math.ceil(2 * pairs / PASS_TERMS)) if pairs > PASS_TERMS else 1, None
    item_kind = wanted.schema["__item"].dataType.simpleString()
    for k in range(passes):
        own = wanted.where(F.pmod(F.xxhash64("__item"), F.lit(passes)) == k).collect()  # of about PASS_TERMS / 2 terms
        if not own and out is not None:
            continue
        known = sorted({t for r in own for t in r.terms})
        number = {t: i for i, t in enumerate(known)}
        index, weights = impact_index(docs, known, id_col, text_col, block_docs)
        found = search_index(index, [[number[t] for t in r.terms] for r in own], [weights[t] for t in known], top)
        names = spark.createDataFrame([(i, r["__item"]) for i, r in enumerate(own)], f"item int, __item {item_kind}")
        found = found.join(F.broadcast(names), "item").select(F.col("__item").alias(item_col), "rank", F.col("__id").alias(id_col), "score")
        out = found if out is None else out.unionByName(found)
    return out
