"""Removal of repeated passages over a De Bruijn graph of words.

Nodes are ``window - 1`` consecutive words, edges are windows of ``window`` words from one node to the next. An edge is repeated if
it occurs in two documents or more; its source is its first occurrence in the document with the smallest id. Of equal
texts only the one with the smallest id takes part; the others repeat it as a whole, unless they are shorter than a window.

1. Anchors. A window's anchor is the smallest hash among its ``anchor``-word shingles; equal windows have equal anchors,
   and only about a fifth of the shingles are anchors. Spark counts the documents of each anchor. Windows whose anchor two
   documents or more hold go on: up to FILTER_ANCHORS anchors set bits in a bitmap, which a wrong bit can only make longer;
   more of them are joined with the windows by a shuffle.
2. Runs. Neighbouring windows that go on become one row with the hashes of their nodes, stored once for all that follows.
3. Edges. Runs are taken apart into edges; partial aggregates find each edge's source and whether it is repeated.
4. Compaction. Joins find the nodes that one repeated edge enters and one leaves. Where these two edges follow each other in
   their source, they belong to one path: paths are the nonbranching stretches of the graph inside one source document.
5. Occurrences. A join takes the edges' paths back to the runs; edges that occur very often are joined by a broadcast of
   bounded size. Neighbouring words of a document on one path, at one distance from the source, form a span.
6. Verification. A span is compared word by word with its source coordinates. A span that differs stays: its windows met others
   with the same hashes, and the whole is done again with other hashes, until all spans are equal to their sources.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import SLICE_BYTES, arrow_task, clean_texts, dropped, keyed_rows, shingle_hashes, slice_hashes, slices, small, staged

WORD = r"[^\x20\x09-\x0D]+"
#: Bits of the anchor filter (16 MB), and repeated anchors up to which it is used.
FILTER_BITS, FILTER_ANCHORS = 1 << 27, 1 << 24
#: Groups of equal texts up to which their table is broadcast; a larger one is joined by a shuffle.
BROADCAST_GROUPS = 500_000
#: An edge with more occurrences than this and than a share of all is joined by broadcast: HOT_SHARE edges at most.
HOT_ROWS, HOT_SHARE = 2_000, 100_000
#: Rounds with other hashes that are tried.
ROUNDS = 8


def _sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each ``w`` consecutive values, by doubling."""
    span = 1
    while span * 2 <= w:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    rest = w - span
    return np.minimum(h[: len(h) - rest], h[rest:]) if rest else h


def node_hashes(h: np.ndarray, words: int, salt: int, bits: int = 64) -> np.ndarray:
    """Hashes of each ``words`` consecutive words, given the words' hashes. With fewer bits, the first salt's meet often."""
    return shingle_hashes(h, words, 2 + salt) >> np.uint64(64 - bits if salt == 0 else 0)


def _windows(texts: pa.Array, window: int, anchor: int, salt: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a slice of texts: word hashes and where each text's start; place among all words and anchor of each window.

    The words' hashes are others for each salt as well: two words that meet in one round are told apart in the next."""
    h, starts = slice_hashes(texts, seed=salt)
    h = h >> np.uint64(64 - bits if salt == 0 else 0)
    if len(h) < window:
        return h, starts, np.zeros(0, np.int64), h[:0]
    row = np.repeat(np.arange(len(texts)), np.diff(starts))
    at = np.flatnonzero(row[: len(h) - window + 1] == row[window - 1 :])
    return h, starts, at, _sliding_min(shingle_hashes(h, anchor, 1), window - anchor + 1)[at]


def _anchors(window: int, anchor: int, salt: int, bits: int):
    """Texts to the anchors of each, once a text."""

    def run(batches):
        for batch in batches:
            texts = clean_texts(batch.column("__text"))
            for i, j in slices(texts):
                _, starts, at, low = _windows(texts.slice(i, j - i), window, anchor, salt, bits)
                row = np.searchsorted(starts, at, "right")
                order = np.lexsort((low, row))
                row, low = row[order], low[order]
                new = np.concatenate([[True], (row[1:] != row[:-1]) | (low[1:] != low[:-1])]) if len(low) else np.zeros(0, bool)
                yield pa.RecordBatch.from_arrays([pa.array(low[new].view(np.int64), pa.int64())], names=["h"])

    return arrow_task(run)


def _runs(window: int, anchor: int, salt: int, bits: int, shared):
    """Rows (id, tie, text) to runs of windows: id, tie, first word, nodes, anchor. With a filter, windows whose anchor
    is in it, in runs as long as can be; without one all windows, in runs of one anchor."""

    def run(batches):
        for batch in batches:
            texts = clean_texts(batch.column("__text"))
            for i, j in slices(texts):
                h, starts, at, low = _windows(texts.slice(i, j - i), window, anchor, salt, bits)
                if shared is not None:
                    bit = low & np.uint64(FILTER_BITS - 1)
                    there = (shared.value[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
                    at, low = at[there], low[there]
                if not len(at):
                    continue
                row = np.searchsorted(starts, at, "right") - 1
                cut = (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)
                first = np.flatnonzero(np.concatenate([[True], cut if shared is not None else cut | (low[1:] != low[:-1])]))
                n = np.diff(np.append(first, len(at))) + 1
                ends = np.cumsum(n)
                nodes = node_hashes(h, window - 1, salt, bits)[np.repeat(at[first] - (ends - n), n) + np.arange(ends[-1])]
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(nodes.view(np.int64)))
                own, word = pa.array(row[first] + i), pa.array(at[first] - starts[row[first]], pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column("__id").take(own), batch.column("__tie").take(own), word, lists, pa.array(low[first].view(np.int64))], names=["__id", "__tie", "start", "nodes", "h"])

    return arrow_task(run)


def _spoken(batches):
    """Texts and wanted stretches (first word, words) to the words of each stretch, about a slice's bytes at a time."""

    def rows():
        own = pa.array(at, pa.int64())
        return pa.RecordBatch.from_arrays([batch.column("__id").take(own), batch.column("__tie").take(own), pa.array(start, pa.int32()), pa.array(n, pa.int32()), pa.array(words, pa.string())], names=["sid", "stie", "sstart", "n", "words"])

    for batch in batches:
        at, start, n, words, held = [], [], [], [], 0
        for i, (text, wanted) in enumerate(zip(clean_texts(batch.column("__text")).cast(pa.binary()), batch.column("wanted"), strict=True)):
            own = text.as_py().split()
            for s in wanted.as_py():
                at.append(i)
                start.append(s["sstart"])
                n.append(s["n"])
                words.append(b" ".join(own[s["sstart"] : s["sstart"] + s["n"]]).decode())
                held += len(words[-1])
                if held >= SLICE_BYTES:  # near copies in thousands ask one source for stretches of most of its text
                    yield rows()
                    at, start, n, words, held = [], [], [], [], 0
        yield rows()


def _kept(keep_text: bool):
    """Texts and spans (first word, words, source words) to counts, the digest of the words outside of true spans, and the false ones."""

    def run(batches):
        for batch in batches:
            n_words, n_removed, digest, n_false, kept_texts = [], [], [], [], []
            for text, spans in zip(clean_texts(batch.column("__text")).cast(pa.binary()), batch.column("spans"), strict=True):
                words, false = text.as_py().split(), 0
                stay = np.ones(len(words), bool)
                for s in spans.as_py() or ():
                    if s["n"] < 0:
                        stay[:] = False
                    elif words[s["start"] : s["start"] + s["n"]] == (s["words"] or "").encode().split():
                        stay[s["start"] : s["start"] + s["n"]] = False
                    else:
                        false += 1
                kept = b" ".join([w for w, k in zip(words, stay.tolist(), strict=True) if k] if spans.is_valid else words)
                n_words.append(len(words))
                n_removed.append(int(len(words) - stay.sum()))
                digest.append(hashlib.sha256(kept).hexdigest())
                n_false.append(false)
                if keep_text:
                    kept_texts.append(kept.decode())
            columns = [batch.column("__id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digest, pa.string()), pa.array(n_false, pa.int64())]
            names = ["__id", "n_words", "n_removed", "kept_sha256", "n_false"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(kept_texts, pa.string())] if keep_text else columns, names=[*names, "kept_text"] if keep_text else names)

    return arrow_task(run)


def _with_first(rows: DataFrame) -> DataFrame:
    """``rows`` with an id and ``__first`` (id, tie), the first row with the same text if there are several rows, else null."""
    rows = rows.where(F.col("__id").isNotNull()).withColumn("__digest", F.unhex(F.sha2("__text", 256)))
    groups = rows.groupBy("__digest").agg(F.min(F.struct("__id", "__tie")).alias("__first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("__digest", "__first")
    groups = staged(groups, "equal-texts")
    return rows.join(F.broadcast(groups) if groups.count() <= BROADCAST_GROUPS else groups, "__digest", "left").drop("__digest")


def window_runs(rows: DataFrame, window: int, anchor: int, salt: int = 0, bits: int = 64) -> DataFrame:
    """Runs of windows that two documents or more may hold: ``__id, __tie, start, nodes``."""
    repeated = staged(rows.select("__text").mapInArrow(_anchors(window, anchor, salt, bits), "h long").groupBy("h").count().where("count > 1").select("h"), "anchors")
    kind = f"__id {rows.schema['__id'].dataType.simpleString()}, __tie binary, start int, nodes array<long>, h long"
    if repeated.count() > FILTER_ANCHORS:
        runs = rows.mapInArrow(_runs(window, anchor, salt, bits, None), kind).join(repeated, "h", "left_semi")
    else:
        bit = F.col("h").bitwiseAND(F.lit(FILTER_BITS - 1)) + 1
        blocks = repeated.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
        filled = np.zeros(FILTER_BITS // 8, np.uint8)
        for block, own in blocks.toLocalIterator():  # FILTER_BITS / 32768 rows of 4 KB at most
            filled[(block - 1) * 4096 : block * 4096] = np.frombuffer(own, np.uint8)
        runs = rows.mapInArrow(_runs(window, anchor, salt, bits, rows.sparkSession.sparkContext.broadcast(filled)), kind)
    runs = staged(runs.drop("h"), "runs")
    dropped(repeated)
    return runs


def edges_of(runs: DataFrame) -> DataFrame:
    """``u, v, __id, __tie, pos``: an edge from node to node for each window."""
    n = F.size("nodes") - 1
    pairs = F.arrays_zip(F.slice("nodes", 1, n).alias("u"), F.slice("nodes", 2, n).alias("v"))
    return runs.select("__id", "__tie", "start", F.posexplode(pairs).alias("i", "e")).select(F.col("e.u").alias("u"), F.col("e.v").alias("v"), "__id", "__tie", (F.col("start") + F.col("i")).alias("pos"))


def compacted(edges: DataFrame) -> DataFrame:
    """Repeated edges with source and path: ``u, v, sid, stie, spos, path, n``; ``path`` is the source position of the path's first edge."""
    at = F.struct("__id", "__tie", "pos")
    found = edges.groupBy("u", "v").agg(F.min(at).alias("s"), F.max(F.struct("__id", "__tie")).alias("last"), F.count(F.lit(1)).alias("n"))
    found = staged(found.where("s.__id < last.__id").select("u", "v", F.col("s.__id").alias("sid"), F.col("s.__tie").alias("stie"), F.col("s.pos").alias("spos"), "n"), "repeated-edges")
    # A node that one edge enters and one leaves: (document, position) of both.
    doc = F.xxhash64("sid", "stie")
    ends = found.select(F.col("v").alias("node"), doc.alias("in_doc"), F.col("spos").alias("in_pos"), F.lit(None).cast("long").alias("out_doc"), F.lit(None).cast("int").alias("out_pos"))
    begins = found.select(F.col("u").alias("node"), F.lit(None).cast("long").alias("in_doc"), F.lit(None).cast("int").alias("in_pos"), doc.alias("out_doc"), F.col("spos").alias("out_pos"))
    nodes = ends.unionByName(begins).groupBy("node").agg(*(F.min(c).alias(c) for c in ("in_doc", "in_pos", "out_doc", "out_pos")), F.count("in_pos").alias("n_in"), F.count("out_pos").alias("n_out"))
    links = nodes.where("n_in = 1 and n_out = 1 and in_doc = out_doc and out_pos = in_pos + 1").select(F.col("node").alias("u"), F.col("out_doc").alias("__doc"), F.col("out_pos").alias("spos"))
    links = links.withColumn("goes_on", F.lit(True))
    # Links tell for an edge (by its first node and its source) that the edge before it in the source leads to it alone.
    edges = found.withColumn("__doc", doc).join(links, ["u", "__doc", "spos"], "left")
    order = Window.partitionBy("sid", "stie").orderBy("spos")
    path = F.max(F.when(F.col("goes_on").isNull(), F.col("spos"))).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = staged(edges.withColumn("path", path).select("u", "v", "sid", "stie", "spos", "path", "n"), "paths")
    dropped(found)
    return out


def occurrences(edges: DataFrame, paths: DataFrame) -> DataFrame:
    """Windows that also start in a document with a smaller id: ``__id, __tie, pos`` with source and path."""
    held = ["__id", "__tie", "pos", "sid", "stie", "spos", "path"]
    total = paths.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = staged(paths.where(F.col("n") > max(HOT_ROWS, total // HOT_SHARE)), "hot-edges")
    rare = paths.join(F.broadcast(hot.select("u", "v")), ["u", "v"], "left_anti")
    found = [edges.join(F.broadcast(hot.select("u", "v")), ["u", "v"], "left_anti").join(rare, ["u", "v"]), edges.join(F.broadcast(hot), ["u", "v"])] if not hot.isEmpty() else [edges.join(paths, ["u", "v"])]
    return found[0].where("sid < __id").select(held) if len(found) == 1 else found[0].where("sid < __id").select(held).unionByName(found[1].where("sid < __id").select(held))


def repeated_spans(rows: DataFrame, window: int = 13, anchor: int = 5, salt: int = 0, bits: int = 64) -> DataFrame:
    """Spans of rows (``__id, __tie, __text``) that repeat a document with a smaller id: ``__id, __tie, start, n, sid, stie, sstart``.

    ``start`` is the first word, ``n`` the number of words, and ``sid, stie, sstart`` the source's first word: the spans lie on one path.
    A copy of a whole text of a window or more has ``n`` = -1; shorter texts repeat nothing. Rows without an id are neither sources nor repeats. Spans rest on hashes of words: whoever
    acts on them compares them with their source, as ``remove_repeats`` does."""
    rows = _with_first(rows)
    me = F.struct("__id", "__tie")
    copy = F.coalesce(me > F.col("__first"), F.lit(False))
    has_window = F.regexp_count("__text", F.lit(WORD)) >= window
    whole = rows.where(copy & (F.col("__id") > F.col("__first.__id")) & has_window).select("__id", "__tie", F.lit(0).alias("start"), F.lit(-1).alias("n"), F.col("__first.__id").alias("sid"), F.col("__first.__tie").alias("stie"), F.lit(0).alias("sstart"))
    runs = window_runs(rows.where(~copy).select("__id", "__tie", "__text"), window, anchor, salt, bits)
    edges = edges_of(runs)
    paths = compacted(edges)
    found = staged(occurrences(edges, paths), "occurrences")
    dropped(runs, paths)
    order = Window.partitionBy("__id", "__tie").orderBy("pos")
    same = lambda c: F.lag(c).over(order) == F.col(c)
    # A row that is repeated with its id and text gives every position again: a step of 0.
    step = F.col("pos") - F.lag("pos").over(order)
    goes_on = (step <= 1) & (F.col("spos") - F.lag("spos").over(order) == step) & same("sid") & same("stie") & same("path")
    found = found.withColumn("__new", F.when(goes_on, 0).otherwise(1)).withColumn("__span", F.sum("__new").over(order))
    spans = found.groupBy("__id", "__tie", "__span").agg(F.min("pos").alias("start"), (F.max("pos") - F.min("pos") + window).alias("n"), *(F.first(c).alias(c) for c in ("sid", "stie")), F.min("spos").alias("sstart"))
    return spans.drop("__span").unionByName(whole)


def _sources(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """``sid, stie, sstart, n, words``: the words that spans repeat, taken from their sources."""
    kind = rows.schema["__id"].dataType.simpleString()
    wanted = spans.where("n > 0").select("sid", "stie", "sstart", "n").distinct().groupBy("sid", "stie").agg(F.collect_list(F.struct("sstart", "n")).alias("wanted"))
    wanted = staged(wanted.select(F.col("sid").alias("__wid"), F.col("stie").alias("__wtie"), "wanted"), "wanted")
    same = (F.col("__id") == F.col("__wid")) & (F.col("__tie") == F.col("__wtie"))
    texts = rows.join(small(wanted.select("__wid", "__wtie")), same, "left_semi").join(wanted, same).select("__id", "__tie", "__text", "wanted")
    return texts.mapInArrow(arrow_task(_spoken), f"sid {kind}, stie binary, sstart int, n int, words string")


def remove_repeats(docs: DataFrame, window: int = 13, anchor: int = 5, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True, bits: int = 64) -> DataFrame:
    """Per row: ``id_col, n_words, n_removed, kept_sha256`` and, with ``keep_text``, ``kept_text``: texts without the words of repeated windows.

    Windows are judged on the input. Words are runs of characters other than ASCII white space; kept ones are joined by
    one space. Null and empty texts have no words, and their digest is that of the empty string. Texts shorter than a
    window are untouched. Rows repeated with one id are not each other's source. Other columns are not read. ``bits`` are those
    of the first round's hashes: with few, words meet by chance, and later rounds mend it.
    """
    rows = keyed_rows(docs, id_col, text_col).select("__id", "__tie", "__text")
    kind = rows.schema["__id"].dataType.simpleString()
    columns = f"__id {kind}, n_words long, n_removed long, kept_sha256 string, n_false long" + (", kept_text string" if keep_text else "")
    held = None
    for salt in range(ROUNDS):
        spans = staged(repeated_spans(rows, window, anchor, salt, bits), "spans")
        words = spans.where("n > 0").join(_sources(rows, spans), ["sid", "stie", "sstart", "n"]).select("__id", "__tie", "start", "n", "words")
        own = words.unionByName(spans.where("n < 0").select("__id", "__tie", "start", "n", F.lit(None).cast("string").alias("words")))
        held = own if held is None else held.unionByName(own)
        by_row = held.groupBy("__id", "__tie").agg(F.collect_list(F.struct("start", "n", "words")).alias("spans"))
        by_row = staged(by_row.select(F.col("__id").alias("__sid"), F.col("__tie").alias("__stie"), "spans"), "spans-by-row")
        joined = rows.join(by_row, (F.col("__id") == F.col("__sid")) & (F.col("__tie") == F.col("__stie")), "left").select("__id", "__text", "spans")
        out = staged(joined.mapInArrow(_kept(keep_text), columns), "kept")
        n_false = out.agg(F.coalesce(F.sum("n_false"), F.lit(0))).first()[0]
        if n_false == (0 if salt == 0 else known):
            return out.drop("n_false").withColumnRenamed("__id", id_col)
        known = n_false
    raise RuntimeError(f"hashes of words met by chance in {ROUNDS} rounds")
