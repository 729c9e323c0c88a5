"""SimHash fingerprints, BK-trees over shards of them, and near-duplicate groups.

Fingerprints within the radius are found in shards. A shard's distinct fingerprints form a BK-tree: a node's children
are keyed by their integer Hamming distance to it, and a search goes only along edges whose key differs from the
distance between query and node by the radius at most. A task builds the trees of many shards at once, level by level, and
searches them for all of their fingerprints at once.

A small radius uses blocks: 64 bits in b > r blocks, and one shard for each value of each choice of b - r blocks; two
fingerprints that differ in r bits or fewer agree on one of the choices at least, so no link is lost. A large radius
(near copies with a given share of changed shingles) uses shards of documents that agree on two of the
smallest hashes of their shingles, several times with other hash functions. There the sketch only names candidates, with a
radius that practically no pair at the similarity exceeds. Documents that candidates tie together form a shard, which is searched once
more with their shingles, and two are linked only if the exact Jaccard similarity of these is high enough.

Trees are built in the tasks that hold their shard's queries. They are not broadcast: all trees together have no bound, and a
broadcast would bring the fingerprints of all documents to the driver.
Inside a shard only links to a group's first member leave the task, so a group of k near copies gives k - 1 links.

A shard of more than SHARD_MOST rows never reaches a task whole. Spark takes one of its fingerprints as the root of the tree and
computes all edges to it: rows within the radius are linked to the root and leave; rows at most two radii away are searched
against those of them that their edge allows, in blocks; rows beyond the radius go on as a smaller shard. What is still
large after LEADER_ROUNDS roots is searched in pairs of blocks. No link is lost on the way. With shingles, edges are
Jaccard distances, which obey the triangle inequality as Hamming distances do.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import arrow_task, clean_texts, dropped, keyed_rows, mixed, shingle_hashes, slice_hashes, slices, small, staged
from touchline.operators.graph import connected_components

#: Queries that go down the trees together.
QUERIES = 2048
#: Fingerprints a block shard holds on average, before more blocks are used.
SHARD_ROWS = 512
#: Rows of a shard that are searched in one task, and roots taken out of a larger one before it is searched in blocks.
SHARD_MOST, LEADER_ROUNDS = 1024, 4
#: Shards of the sketch: pairs of smallest hashes. A pair with similarity 0.8 misses all with probability 0.36 ** 10.
BANDS, BAND_ROWS = 10, 2
#: Deviations above the expected distance up to which a pair of sketches is a candidate: at the similarity, one in 30,000 lies beyond.
DEVIATIONS = 4


def contract_fingerprint(text: bytes, words: int = 4) -> bytes:
    """64 bits, big-endian: bit i is set if it is set in over half of the shingles' XXH64 (seed 42), repeats included."""
    w = text.lower().split()
    if not w:
        return bytes(8)
    line = b" ".join(w)
    if len(w) <= words:
        return xxhash.xxh64_digest(line, 42)
    size = np.fromiter(map(len, w), np.int64, len(w)) + 1
    end = np.cumsum(size) - 1
    start = end - size + 1
    digest = xxhash.xxh64_digest
    raw = b"".join([digest(line[a:b], 42) for a, b in zip(start[: len(w) - words + 1].tolist(), end[words - 1 :].tolist(), strict=True)])
    return majority(np.frombuffer(raw, np.uint8).reshape(-1, 8))


def majority(rows: np.ndarray) -> bytes:
    """Rows of bytes to the bytes whose bits are set in over half of them."""
    total = np.zeros(rows.shape[1] * 8, np.int64)
    for i in range(0, len(rows), 4096):
        total += np.unpackbits(rows[i : i + 4096], axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(total * 2 > len(rows)).tobytes()


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The distinct shingles of each lower-cased text, as hashes; fewer words: the whole sequence; no words: none."""
    for i, j in slices(texts):
        hashes, starts = slice_hashes(texts.slice(i, j - i), lower=True)
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            yield np.unique(shingle_hashes(hashes[a:b], min(words, b - a))) if b > a else hashes[:0]


def wide_fingerprint(shingles: np.ndarray, lanes: int) -> bytes:
    """64 * ``lanes`` bits over a set of shingles; zero for none."""
    if not len(shingles):
        return bytes(8 * lanes)
    return majority(np.stack([mixed(shingles, 101 + i) for i in range(lanes)], axis=1).view(np.uint8).reshape(len(shingles), 8 * lanes))


def _fingerprints(batches):
    for batch in batches:
        texts = clean_texts(batch.column("__text")).cast(pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("__id"), pa.array([contract_fingerprint(t.as_py()) for t in texts], pa.binary())], names=["__id", "__fp"])


def _band_keys(shingles: np.ndarray) -> list[int]:
    low = [int(mixed(shingles, 201 + i).min()) for i in range(BANDS * BAND_ROWS)]
    return [int(xxhash.xxh64_intdigest(np.array([i, *low[i * BAND_ROWS : (i + 1) * BAND_ROWS]], "<u8").tobytes())) for i in range(BANDS)]


def _wide(words: int, lanes: int) -> Callable:
    def run(batches):
        for batch in batches:
            fps, keys = [], []
            for shingles in shingle_sets(clean_texts(batch.column("__text")), words):
                fps.append(wide_fingerprint(shingles, lanes))
                keys.append([k - (1 << 64) if k >= 1 << 63 else k for k in _band_keys(shingles)] if len(shingles) else [0])
            yield pa.RecordBatch.from_arrays([batch.column("__id"), pa.array(fps, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], names=["__id", "__fp", "__keys"])

    return arrow_task(run)


def _shingle_sets(words: int) -> Callable:
    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 256):  # shingles take more room than the text
                own = batch.slice(i, 256)
                sets = [x.view(np.int64) for x in shingle_sets(clean_texts(own.column("__text")), words)]
                yield pa.RecordBatch.from_arrays([own.column("__id"), own.column("__key"), own.column("__fp"), pa.array(sets, pa.list_(pa.int64()))], names=["__id", "__key", "__fp", "__set"])

    return arrow_task(run)


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances between one fingerprint and many (rows of 64-bit words)."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


class Groups:
    """Disjoint sets of 0..n-1, and the links that joined two of them."""

    def __init__(self, n: int):
        self.up, self.links = list(range(n)), []

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.up[max(a, b)] = min(a, b)
            self.links.append((i, j))


class Sets:
    """Sets of integers, one after the other in ``flat``, and the exact Jaccard similarity of one to others."""

    def __init__(self, flat: np.ndarray, starts: np.ndarray, similarity: float):
        self.values, self.flat = np.unique(flat, return_inverse=True)
        self.starts, self.size, self.similarity = starts, np.diff(starts), similarity
        self.marked = np.zeros(len(self.values), bool)

    def similar(self, i: int, others: np.ndarray) -> np.ndarray:
        """Those of ``others`` that are as similar to row ``i`` as asked for."""
        own = self.size[i]
        low, high = np.minimum(own, self.size[others]), np.maximum(own, self.size[others])
        others = others[(low > 0) & (low / np.maximum(high, 1) >= self.similarity)]
        if not len(others):
            return others
        at = self.flat[self.starts[i] : self.starts[i + 1]]
        self.marked[at] = True
        both = np.fromiter((np.count_nonzero(self.marked[self.flat[self.starts[j] : self.starts[j + 1]]]) for j in others.tolist()), np.int64, len(others))
        self.marked[at] = False
        return others[both / (own + self.size[others] - both) >= self.similarity]


def set_links(fps: np.ndarray, radius: int, sets: Sets, known: np.ndarray) -> list[tuple[int, int]]:
    """Links between rows within the radius whose sets are similar too; a pair inside one group is not compared.

    Rows that are ``known`` to be in one group start as one; no links are given for that."""
    groups = Groups(len(fps))
    for i in np.flatnonzero(known)[1:].tolist():
        groups.join(i, int(np.flatnonzero(known)[0]))
    groups.links.clear()
    for i in range(1, len(fps)):
        near = np.flatnonzero(hamming(fps[:i], fps[i]) <= radius)
        while len(near):
            own = groups.root(i)
            near = near[np.fromiter((groups.root(j) != own for j in near.tolist()), bool, len(near))]
            for j in sets.similar(i, near[:64]).tolist():
                groups.join(i, j)
            near = near[64:]
    return groups.links


def bk_forest(fps: np.ndarray, shard: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(parent, edge) of each fingerprint in its shard's BK-tree; roots, the first of each shard, have the parent -1.

    All trees grow by one level at a time: the first of each branch becomes its node, the others go to the branches keyed by
    their distance to it."""
    parent, edge = np.full(len(fps), -1), np.zeros(len(fps), np.int64)
    left, branch = np.arange(len(fps)), shard.astype(np.int64)
    while len(left):
        order = np.argsort(branch, kind="stable")
        left, branch = left[order], branch[order]
        first = np.concatenate([[True], branch[1:] != branch[:-1]])
        node = left[first][np.cumsum(first) - 1][~first]
        left = left[~first]
        parent[left], edge[left] = node, hamming(fps[left], fps[node])
        branch = node * (64 * fps.shape[1] + 1) + edge[left]
    return parent, edge


def bk_hits(fps: np.ndarray, shard: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of one shard within the radius, found by going down the shards' trees."""
    parent, edge = bk_forest(fps, shard)
    roots = np.flatnonzero(parent < 0)
    root = roots[np.searchsorted(shard[roots], shard)]
    span = 64 * fps.shape[1] + 1
    children = np.argsort(parent * span + edge, kind="stable")[len(roots) :]
    keys = parent[children] * span + edge[children]
    for i in range(0, len(fps), QUERIES):
        query = np.arange(i, min(i + QUERIES, len(fps)))
        node = root[query]
        while len(query):
            d = hamming(fps[query], fps[node])
            near = (d <= radius) & (query > node)
            yield query[near], node[near]
            low = np.searchsorted(keys, node * span + np.maximum(d - radius, 0))
            n = np.searchsorted(keys, node * span + np.minimum(d + radius, span - 1), "right") - low
            at = np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)
            query, node = np.repeat(query, n), children[at]


def bk_links(fps: np.ndarray, shard: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of each row to the first row of its group: rows of a shard that are connected within the radius. ``shard`` ascends."""
    low = np.arange(len(fps))
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def settle() -> None:
        a, b = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        while len(a):
            m = np.minimum(low[a], low[b])
            np.minimum.at(low, low[a], m)
            np.minimum.at(low, low[b], m)
            while (low[low] != low).any():
                low[:] = low[low]
            apart = low[a] != low[b]
            a, b = a[apart], b[apart]

    for pair in bk_hits(fps, shard, radius):
        held.append(pair)
        if sum(len(a) for a, _ in held) > 1 << 20:
            settle()
    if held:
        settle()
    row = np.flatnonzero(low != np.arange(len(fps)))
    return row, low[row]


def _shard_links(radius: int, similarity: float | None) -> Callable:
    """Rows (__key, __fp, __id), with a similarity also __set and __known, sorted by key to links (a, b) between ids; a shard may span Arrow batches."""

    def links(rows: list[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
        table = pa.Table.from_batches(rows)
        key = table.column("__key").to_numpy()
        raw = table.column("__fp").combine_chunks().cast(pa.binary())
        fps = np.frombuffer(b"".join(raw.to_pylist()), np.uint64).reshape(len(table), -1)
        ids = table.column("__id").combine_chunks()
        cut = np.flatnonzero(np.diff(key)) + 1
        if similarity is None:
            shard = np.zeros(len(key), np.int64)
            shard[cut] = 1
            a, b = bk_links(fps, np.cumsum(shard), radius)
            yield ids.take(pa.array(a)), ids.take(pa.array(b))
            return
        known = table.column("__known").to_numpy()
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(key)], strict=True):
            if b - a > 1:
                own = table.column("__set").slice(a, b - a).combine_chunks()
                starts = own.offsets.to_numpy()
                got = set_links(fps[a:b], radius, Sets(own.flatten().to_numpy(), (starts - starts[0]).astype(np.int64), similarity), known[a:b])
                if got:
                    at = np.array(got) + a
                    yield ids.take(pa.array(at[:, 0])), ids.take(pa.array(at[:, 1]))

    def run(batches):
        kept: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column("__key").to_numpy(zero_copy_only=False)
            change = np.flatnonzero(key != key[-1])
            end = int(change[-1]) + 1 if len(change) else 0
            if kept and (end or kept[-1].column("__key")[-1].as_py() != key[0]):
                done = [*kept, batch.slice(0, end)] if end else kept
                kept = []
            else:
                done = [batch.slice(0, end)] if end and not kept else []
            for a, b in links(done) if done else ():
                yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"])
            kept.append(batch.slice(end))
        for a, b in links(kept) if kept else ():
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"])

    return arrow_task(run)


def _searched(shards: DataFrame, radius: int, similarity: float | None = None) -> DataFrame:
    """Links ``a, b`` inside shards (``__key, __fp, __id``, with a similarity also ``__set, __known``) of bounded size, each searched in one task."""
    kind = shards.schema["__id"].dataType.simpleString()
    dealt = shards.select("__key", "__fp", "__id", *_sets(similarity)).repartition("__key").sortWithinPartitions("__key")
    return dealt.mapInArrow(_shard_links(radius, similarity), f"a {kind}, b {kind}")


def _sets(similarity: float | None) -> list[str]:
    return [] if similarity is None else ["__set", "__known"]


def _distance(a: str, b: str, lanes: int) -> Column:
    word = lambda c, i: F.conv(F.hex(F.substring(c, 8 * i + 1, 8)), 16, -10).cast("long")
    return reduce(lambda x, y: x + y, [F.bit_count(word(a, i).bitwiseXOR(word(b, i))) for i in range(lanes)])


def _jaccard(a: str, b: str) -> Column:
    """Similarity of two arrays without repeated values."""
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def _dealt(rows: DataFrame, own: Column, others: Column, held: list[str]) -> DataFrame:
    """Each row in its own block, once for each block it is searched against: ``held``."""
    return rows.select(*held, F.pmod(F.xxhash64("__fp", "__id"), own).alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), others - 1)).alias("other"))


def _links(shards: DataFrame, radius: int, lanes: int, similarity: float | None = None) -> DataFrame:
    """``a, b``: links that connect all rows of a shard (``__key, __fp, __id``) within the radius of each other.

    With a similarity, the rows hold their shingles as ``__set`` and links are between similar sets only.
    """
    half = SHARD_MOST // 2
    if similarity is not None:
        shards = shards.withColumn("__known", F.lit(False))
    held = ["__key", "__fp", "__id", *_sets(similarity)]
    blocks = lambda c: F.greatest(F.lit(1), F.ceil(F.col(c) / half)).cast("long")
    shards = staged(shards.select(*held), "shards")
    found = []
    for round_ in range(LEADER_ROUNDS + 1):
        hot = shards.groupBy("__key").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("__fp", "__id")).alias("root")).where(F.col("n") > SHARD_MOST)
        hot = staged(hot.select("__key", "n", F.col("root.__fp").alias("root_fp"), F.col("root.__id").alias("root_id")), "hot-shards")
        if hot.isEmpty():
            found.append(_searched(shards, radius, similarity))
            break
        found.append(_searched(shards.join(hot, "__key", "left_anti"), radius, similarity))
        rows = shards.join(hot, "__key")
        if round_ == LEADER_ROUNDS:
            pairs = _dealt(rows, blocks("n"), blocks("n"), held)
            found.append(_searched(pairs.withColumn("__key", F.xxhash64("__key", F.least("own", "other"), F.greatest("own", "other"))), radius, similarity))
            break
        if similarity is None:
            reach, edge = radius, _distance("__fp", "root_fp", lanes)
            inside = edge <= radius
        else:
            roots = shards.select("__key", F.col("__id").alias("root_id"), F.col("__set").alias("root_set")).join(F.broadcast(hot.select("__key", "root_id")), ["__key", "root_id"]).dropDuplicates(["__key"])
            rows = rows.join(staged(roots.select("__key", "root_set"), "roots"), "__key")
            # The sum of two distances may be rounded: a little more is searched, and judged exactly there.
            reach, edge = 1 - similarity + 1e-9, 1 - _jaccard("__set", "root_set")
            inside = _jaccard("__set", "root_set") >= similarity
        rows = staged(rows.select(*held, "root_id", edge.alias("edge"), inside.alias("inside")), "edges")
        inside = F.col("inside")
        if similarity is not None:
            rows = rows.withColumn("__known", inside)  # those that the root ties together
        fringe = ~inside & (F.col("edge") <= 2 * reach)
        found.append(rows.where(inside & ~F.col("__id").eqNullSafe(F.col("root_id"))).select(F.col("__id").alias("a"), F.col("root_id").alias("b")))
        nearest = rows.where(fringe).groupBy("__key").agg(F.count(F.lit(1)).alias("n_fringe"), F.min("edge").alias("least"))
        close = rows.where(inside).join(nearest, "__key").where(F.col("edge") >= F.col("least") - reach)
        counts = staged(close.groupBy("__key", "n_fringe", "least").agg(F.count(F.lit(1)).alias("n_inside")), "fringes")
        shard = lambda i, j: F.xxhash64("__key", F.col(i), F.col(j))
        one = _dealt(rows.where(inside).join(counts, "__key").where(F.col("edge") >= F.col("least") - reach), blocks("n_inside"), blocks("n_fringe"), held).withColumn("__key", shard("own", "other"))
        two = _dealt(rows.where(fringe).join(counts, "__key"), blocks("n_fringe"), blocks("n_inside"), held).withColumn("__key", shard("other", "own"))
        found.append(_searched(one.select(*held).unionByName(two.select(*held)), radius, similarity))
        shards = rows.where(~inside).select(*held)
        if similarity is not None:
            shards = shards.withColumn("__known", F.lit(False))
    return reduce(DataFrame.unionByName, found)


def block_shards(fps: DataFrame, n: int, radius: int) -> DataFrame:
    """Rows ``__fp`` (8 bytes) and ``__id`` to ``__key, __fp, __id``: a row for each choice of blocks.

    The number of blocks follows the number of fingerprints, so that a shard of evenly spread ones keeps its size.
    """
    blocks = radius + 1
    while blocks < radius + 4 and n / 2 ** (64 * (blocks - radius) / blocks) > SHARD_ROWS:
        blocks += 1
    edges = [64 * i // blocks for i in range(blocks + 1)]
    value = F.conv(F.hex("__fp"), 16, -10).cast("long")
    part = [F.shiftrightunsigned(value, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)) for lo, hi in zip(edges, edges[1:], strict=False)]
    keys = F.array(*(F.xxhash64(F.lit(i), *(part[k] for k in chosen)) for i, chosen in enumerate(combinations(range(blocks), blocks - radius))))
    return fps.select(F.explode(keys).alias("__key"), "__fp", "__id")


def fingerprint_components(docs: DataFrame, radius: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id_col, fingerprint, component_id``: links join fingerprints that differ in ``radius`` bits at most.

    Fingerprints are taken over 4-word shingles of the lower-cased (A-Z) text, repeats included; fewer words count as one
    shingle, none give zero, which links like any other. ``component_id`` is the smallest id reachable, the row's own
    included. Null texts have no words. Null ids take part; a component with null ids only has a null
    ``component_id``. Copies collapse to one fingerprint before the search, so a large group of them costs one row.
    """
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    kind = rows.schema["__id"].dataType.simpleString()
    marked = staged(rows.mapInArrow(arrow_task(_fingerprints), f"__id {kind}, __fp binary"), "fingerprints")
    distinct = staged(marked.groupBy("__fp").agg(F.min("__id").alias("__low")), "distinct")
    value = F.conv(F.hex("__fp"), 16, -10).cast("long")
    nodes = distinct.select("__fp", value.alias("__id"))
    links = staged(_links(block_shards(nodes, distinct.count(), radius), radius, 1), "near")
    components = connected_components(links, staged)
    joined = distinct.withColumn("__node", value).join(components, F.col("__node") == F.col("node"), "left")
    joined = staged(joined.select("__fp", "__low", F.coalesce("component", "__node").alias("__component")), "joined")
    low = joined.groupBy("__component").agg(F.min("__low").alias("component_id"))
    labels = joined.join(low, "__component").select("__fp", "component_id")
    return marked.join(labels, "__fp").select(F.col("__id").alias(id_col), F.lower(F.hex("__fp")).alias("fingerprint"), "component_id")


def similarity_radius(similarity: float, bits: int) -> int:
    """The expected distance of two fingerprints whose sets have this Jaccard similarity, and DEVIATIONS deviations."""
    p = float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)
    return int(np.floor(bits * p + DEVIATIONS * (bits * p * (1 - p)) ** 0.5))


def _shared(shards: DataFrame) -> DataFrame:
    """Without the shards of one row."""
    return shards.join(shards.groupBy("__key").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__key"), "__key")


def _near(rows: DataFrame, words: int, similarity: float, lanes: int) -> DataFrame:
    """``rows``: ``__id`` (any type with an order), ``__text``. ``node, component`` of those with a partner."""
    kind = rows.schema["__id"].dataType.simpleString()
    radius = similarity_radius(similarity, 64 * lanes)
    marked = staged(rows.mapInArrow(_wide(words, lanes), f"__id {kind}, __fp binary, __keys array<long>").where("size(__keys) > 1"), "wide")
    exploded = marked.select(F.explode("__keys").alias("__key"), "__fp", "__id")
    near = staged(_links(_shared(exploded), radius, lanes), "near")
    # Only documents with a candidate take their shingles along; those tied together by candidates are one shard.
    tied = connected_components(near, staged)
    tied = staged(tied.select(F.col("node").alias("__id"), F.xxhash64("component").alias("__key")).join(marked.select("__id", "__fp").dropDuplicates(["__id"]), "__id"), "candidates")
    shards = rows.join(small(tied), "__id").mapInArrow(_shingle_sets(words), f"__id {kind}, __key long, __fp binary, __set array<long>")
    links = staged(_links(shards, radius, lanes, similarity), "similar")
    dropped(marked, near, tied)
    return connected_components(links, staged)


def near_groups(docs: DataFrame, words: int = 5, similarity: float = 0.8, lanes: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Near-duplicate groups of whole documents: ``id_col, group_id, group_size`` for documents that have a partner.

    Documents are linked when their sets of ``words``-word shingles have a Jaccard similarity of ``similarity`` or more.
    Candidates are documents that share two smallest shingle hashes and whose fingerprints of 64 * ``lanes`` bits lie
    within a radius that practically no such pair exceeds; every link is compared shingle by shingle (64-bit hashes of them).
    Rows without words or without an id form no groups. ``group_id`` is the smallest id of the group. Rows that share an id
    and not the text are documents of their own; rows alike in both are one.
    """
    rows = keyed_rows(docs, id_col, text_col).where(F.col("__id").isNotNull()).select(F.struct("__id", "__tie").alias("__id"), "__text")
    components = staged(_near(rows, words, similarity, lanes), "near-groups")
    size = components.groupBy("component").agg(F.count(F.lit(1)).alias("group_size"))
    return components.join(size, "component").select(F.col("node.__id").alias(id_col), F.col("component.__id").alias("group_id"), "group_size")


def without_near_copies(docs: DataFrame, words: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, without those of a group other than its first document.

    The first is the one with the smallest id (of rows that share it, the smallest SHA-256 of the text). Rows that share an id
    are judged by their own text; rows alike in both share their fate."""
    rows = keyed_rows(docs, id_col, text_col, whole=True)
    near = _near(rows.where(F.col("__id").isNotNull()).select(F.struct("__id", "__tie").alias("__id"), "__text"), words, similarity, 4)
    goes = staged(near.where("node <> component").select(F.col("node.__id").alias("__gid"), F.col("node.__tie").alias("__gtie")), "near-copies")
    return rows.join(small(goes), (F.col("__id") == F.col("__gid")) & (F.col("__tie") == F.col("__gtie")), "left_anti").select("__row.*")
