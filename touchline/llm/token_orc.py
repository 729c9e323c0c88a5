"""Token ids as ORC files: run-length encoded integers, row indexes and Bloom filters on the document ids."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.common import arrow_task, clean_texts, slices, staged
from touchline.llm.tokens import ENCODED_BYTES, encode_slice, tokenizer

#: Rows between two entries of a file's row index; a reader skips whole stretches by their smallest and largest id.
INDEX_STRIDE = 1000
STRIPE_BYTES = 16 << 20


def _lists(path: str, end_id: int):
    """Arrow batches (id, text) to (id, list of ids with the end id, number of the row in its file)."""

    def encode(batches):
        tok, row = tokenizer(path), 0
        for batch in batches:
            texts = clean_texts(batch.column("__text"))
            for i, j in slices(texts, ENCODED_BYTES):
                ids, starts = encode_slice(tok, texts.slice(i, j - i))
                offsets = starts + np.arange(len(starts))
                flat, own = np.full(offsets[-1], end_id, np.int32), np.ones(offsets[-1], bool)
                own[offsets[1:] - 1] = False
                flat[own] = ids.view(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), lists, pa.array(np.arange(row, row + j - i))], names=["doc_id", "ids", "row"])
                row += j - i

    return arrow_task(encode, keep=True)


def write_token_orc(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, files: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text, append ``end_id``, and write ``doc_id, ids, row`` as ORC in ascending ``doc_id`` order.

    Texts, not ids, are dealt out by ranges of ids (smaller, and each file's rows come sorted). Integers use ORC's
    run-length encoding; the row index and a Bloom filter on ``doc_id`` let a reader of a few documents skip
    the other stripes. Null texts count as empty: a list with the end id alone. Rows without an id come first; rows that
    share an id come in the order of their texts' hashes, then texts. ``row`` numbers the rows of a file.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("__text"))
    by = [F.col("doc_id").asc_nulls_first(), F.xxhash64("__text").asc()]
    dealt = rows.repartitionByRange(files, *by) if files else rows.repartitionByRange(*by)
    kind = rows.schema["doc_id"].dataType.simpleString()
    (
        dealt.sortWithinPartitions(*by, "__text")
        .mapInArrow(_lists(tokenizer_path, end_id), f"doc_id {kind}, ids array<int>, row long")
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", INDEX_STRIDE)
        .option("orc.stripe.size", STRIPE_BYTES)
        .option("compression", "zstd")
        .orc(path)
    )


def read_token_orc(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """``doc_id, ids`` of the files, stripe-parallel. ``doc_ids``: only these; the predicate reaches the ORC reader,
    which skips stripes and row groups by their statistics and Bloom filters."""
    rows = spark.read.orc(path).select("doc_id", "ids")
    return rows if doc_ids is None else rows.filter(F.col("doc_id").isin(list(doc_ids)))


def _digests(batches):
    """(doc_id, ids, row, file) to (doc_id, n_tokens, ids_crc32, row, file); ids as little-endian unsigned 32-bit integers."""
    for batch in batches:
        lists = batch.column("ids")
        offsets = lists.offsets.to_numpy()
        raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<i4").view(np.uint8))
        crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(offsets), pa.int64()), pa.array(crc, pa.int64()), batch.column("row"), batch.column("file")], names=["doc_id", "n_tokens", "ids_crc32", "row", "file"])


def token_offsets(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: ``doc_id, start, n_tokens, ids_crc32``; start counts the ids of all documents before.

    Running sums are taken inside each file, in the order of its rows, and over the files' totals, so no task sees more than a
    file's rows or one row a file. Files follow each other by their ids; those of one id alone by their numbers.
    """
    rows = spark.read.orc(path).select("doc_id", "ids", "row", F.col("_metadata.file_name").alias("file"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    per = staged(rows.mapInArrow(arrow_task(_digests), f"doc_id {kind}, n_tokens long, ids_crc32 long, row long, file string"), "token-digests")
    files = per.groupBy("file").agg(F.sum("n_tokens").alias("n"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    number = F.regexp_extract("file", "part-([0-9]+)", 1).cast("long")
    before = Window.orderBy(F.col("lo").asc_nulls_first(), F.col("hi").asc_nulls_first(), number, "file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__file_start"))
    inside = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("__inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return per.join(files, "file").select("doc_id", (F.col("__file_start") + F.col("__inside")).alias("start"), "n_tokens", "ids_crc32")
