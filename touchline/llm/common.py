"""Shared pieces: the shared work folder, staged tables, and words and their hashes inside tasks."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import suppress
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Letters A-Z and a-z, for the ASCII-only lower-casing that the operators' contracts ask for.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Spark's switch for removing an execution's shuffle files when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@lru_cache(maxsize=1)
def _local_work() -> str:
    return tempfile.mkdtemp(prefix="touchline-")


def work_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; in local mode without it, a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _local_work()


def work_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{work_root(spark)}/touchline/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, and a lost executor loses nothing."""
    spark, path = df.sparkSession, work_path(df.sparkSession, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")  # once the table is written, nothing reads the shuffle files behind it
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more: what came of them has been written."""
    for table in tables:
        jvm = table.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(table.staged_path)
        path.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Rows of a staged table up to which it is broadcast; a larger one is joined by a shuffle.
BROADCAST_ROWS = 200_000


def small(table: DataFrame) -> DataFrame:
    """With a broadcast hint if it is small enough. ``table`` is a staged table: counting reads its footers only."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def keyed_rows(docs: DataFrame, id_col: str, text_col: str, whole: bool = False) -> DataFrame:
    """``__id, __tie, __text`` of each row (null texts as empty), with ``whole`` also ``__row``, all its columns.

    (id, tie) names a row: the tie is empty for ids that occur once, else the SHA-256 of the text, so that only rows
    alike in both are one."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("__id"), text.alias("__text"), *([F.struct("*").alias("__row")] if whole else []))
    again = staged(rows.groupBy("__id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("__id").alias("__again"), F.lit(True).alias("__more")), "repeated-ids")
    if again.isEmpty():
        return rows.withColumn("__tie", F.lit(b""))
    marked = rows.join(small(again), F.col("__id").eqNullSafe(F.col("__again")), "left")
    return marked.withColumn("__tie", F.when(F.col("__more"), F.unhex(F.sha2("__text", 256))).otherwise(F.lit(b""))).drop("__again", "__more")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


#: Bytes of text worked on at a time inside a task: what a task holds for its words follows from this, not from the corpus.
SLICE_BYTES = 1 << 20
#: Large objects that a worker keeps from task to task, by name.
kept_objects: dict[str, object] = {}


def give_back() -> None:
    """Freed memory goes back to the system."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def arrow_task(run: Callable, keep: bool = False) -> Callable:
    """``run`` (Arrow batches to Arrow batches) that leaves no memory behind in a worker that goes on to other tasks.

    Objects kept for later tasks go too, unless ``keep`` says that this task uses them."""

    def task(batches):
        if not keep and kept_objects:
            kept_objects.clear()
            give_back()
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


class Memory:
    """What words that occur more than once in a slice came to, in two halves: when the newer is full, the older is forgotten."""

    def __init__(self, most: int, longest: int = 48):
        self.most, self.longest, self.new, self.old = most, longest, {}, {}

    def all(self, words: list) -> list:
        """What is kept of each word; None where nothing is."""
        found = list(map(self.new.get, words))
        if self.old:
            for i in [i for i, x in enumerate(found) if x is None]:
                if (value := self.old.get(words[i])) is not None:
                    found[i] = value
                    self.put(words[i], value)
        return found

    def put(self, word, value) -> None:
        if len(word) <= self.longest:
            if len(self.new) >= self.most:
                self.old, self.new = self.new, {}
            self.new[word] = value


def clean_texts(column: pa.Array) -> pa.Array:
    return column.cast(pa.string()).fill_null("")


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` bytes; a longer text has a range of its own."""
    ends = np.cumsum(np.asarray(pc.binary_length(texts).fill_null(0)), dtype=np.int64)
    i = 0
    while i < len(texts):
        before = ends[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(ends, before + most, "right")))
        yield i, j
        i = j


def slice_words(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(distinct words, number of each word in order, where each text's words start, with the end).

    Words are runs of characters other than ASCII white space."""
    parts = pc.ascii_split_whitespace(texts)
    coded = parts.flatten().dictionary_encode()
    words = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    starts = parts.offsets.to_numpy().astype(np.int64)
    starts = starts - starts[0] if len(starts) else np.zeros(1, np.int64)
    if b"" in words:  # beside white space at an end
        there = codes != words.index(b"")
        starts = np.concatenate([[0], np.cumsum(there)])[starts]
        codes = codes[there]
    return words, codes, starts


def slice_hashes(texts: pa.Array, lower: bool = False, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of all words of the texts in order (in lower case (A-Z) if asked for), and where each text's start."""
    words, codes, starts = slice_words(texts)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(w.lower() if lower else w, seed) for w in words), np.uint64, len(words))
    return hashes[codes] if len(words) else hashes, starts


def mixed(h: np.ndarray, by: int) -> np.ndarray:
    """A bijective scramble of 64-bit values, another one for each ``by``."""
    with np.errstate(over="ignore"):
        h = (h ^ np.uint64(by * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xD6E8FEB86659FD93)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingle_hashes(h: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Order-sensitive 64-bit hashes of each ``k`` consecutive word hashes."""
    n = len(h) - k + 1
    if n <= 0:
        return h[:0]
    out = np.full(n, salt, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            out = out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n]
    return mixed(out, salt + 1)


def word_lengths_to_starts(lengths: np.ndarray) -> np.ndarray:
    """Exclusive running sums, with the total at the end."""
    return np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
