"""Exact de-duplication against a minimal perfect hash of known digests."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import staged

#: Digests a shard holds on average, and the buckets a shard divides them into.
SHARD_KEYS, BUCKETS = 4096, 1024
#: Pilots tried for a bucket; a full table of 4,096 keys needs some thousands at most.
MOST_PILOTS = 10_000_000


def normalised(text: Column) -> Column:
    """White space runs become one space; null is empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


def _signed(h: int) -> int:
    return h - (1 << 64) if h >= 1 << 63 else h


def slot_hash(digest: bytes, pilot: int, n: int) -> int:
    """What ``pmod(xxhash64(digest, pilot), n)`` gives in Spark."""
    return _signed(xxhash.xxh64_intdigest(struct.pack("<q", pilot), xxhash.xxh64_intdigest(digest, 42))) % n


def place_keys(digests: list[bytes], buckets: list[int]) -> tuple[list[int], list[int]]:
    """(pilot of each key's bucket, slot of each key): a bijection from the keys to 0..n-1.

    Hash and displace: buckets are placed largest first, each with the first pilot that sends its keys to different
    free slots; a bucket of one key gets a free slot itself, kept as the negative pilot ``-1 - slot``.
    """
    n = len(digests)
    if len(set(digests)) < n or None in digests:
        raise ValueError("digests must be distinct and not null")
    inside: dict[int, list[int]] = {}
    for i, b in enumerate(buckets):
        inside.setdefault(b, []).append(i)
    free, pilots, slots = np.ones(n, bool), [0] * n, [0] * n
    single = []
    for keys in sorted(inside.values(), key=lambda k: (-len(k), k)):
        if len(keys) == 1:
            single.append(keys[0])
            continue
        for pilot in range(MOST_PILOTS):
            got = [slot_hash(digests[i], pilot, n) for i in keys]
            if len(set(got)) == len(got) and all(free[got]):
                break
        else:
            raise ValueError(f"no pilot below {MOST_PILOTS} places a bucket of {len(keys)} digests")
        for i, s in zip(keys, got, strict=True):
            pilots[i], slots[i], free[s] = pilot, s, False
    for i, s in zip(single, np.flatnonzero(free).tolist(), strict=True):
        pilots[i], slots[i] = -1 - s, s
    return pilots, slots


def _build(table: pa.Table) -> pa.Table:
    table = table.sort_by([("bucket", "ascending"), ("digest", "ascending")])
    pilots, slots = place_keys(table.column("digest").to_pylist(), table.column("bucket").to_pylist())
    n = pa.array(np.full(len(table), len(table)), pa.int64())
    return table.select(["shard", "bucket", "digest", "winner", "copies"]).append_column("pilot", pa.array(pilots, pa.int64())).append_column("slot", pa.array(slots, pa.int64())).append_column("n", n)


def _where(digest: Column, shards: int) -> tuple[Column, Column]:
    h = F.xxhash64(digest)
    return F.pmod(h, F.lit(shards)).alias("shard"), F.pmod(F.shiftright(h, 33), F.lit(BUCKETS)).cast("long").alias("bucket")


class DigestIndex:
    """Pilots by (shard, bucket); slots by (shard, slot) with the full digest, its winner's id and its copies."""

    def __init__(self, pilots: DataFrame, slots: DataFrame, shards: int):
        self.pilots, self.slots, self.shards = pilots, slots, shards


def build_index(known: DataFrame) -> DigestIndex:
    """``known``: digests with their winners and copies (``digest, winner, copies``). Shards are built in parallel tasks.

    A digest that comes several times has the smallest of its winners and the sum of its copies; null digests are left out."""
    once = known.where("digest is not null").groupBy("digest").agg(F.min("winner").alias("winner"), F.sum(F.col("copies").cast("long")).alias("copies"))
    known = staged(once, "digests")
    shards = max(1, -(-known.count() // SHARD_KEYS))
    shard, bucket = _where(F.col("digest"), shards)
    kind = known.schema["winner"].dataType.simpleString()
    built = known.select("*", shard, bucket).groupBy("shard").applyInArrow(_build, f"shard long, bucket long, digest binary, winner {kind}, copies long, pilot long, slot long, n long")
    built = staged(built, "hash")
    return DigestIndex(built.select("shard", "bucket", "pilot", "n").distinct(), built.select("shard", "slot", "digest", "winner", "copies"), shards)


def lookup(rows: DataFrame, index: DigestIndex) -> DataFrame:
    """``rows`` with ``winner``, ``copies`` and ``__member`` of their digest, in place of columns of these names; the first two null
    and the last false where the index doesn't hold it or the digest is null.

    Digest to bucket, bucket to pilot, pilot to slot; the slot's full digest is compared byte for byte. Both joins are
    left joins that adaptive execution can split, so a digest that a third of the rows share is no bottleneck.
    """
    shard, bucket = _where(F.col("digest"), index.shards)
    at = rows.select(F.struct("*").alias("row"), "digest", shard, bucket)
    at = at.join(index.pilots, ["shard", "bucket"], "left")
    slot = F.when(F.col("pilot") < 0, -1 - F.col("pilot")).otherwise(F.pmod(F.xxhash64("digest", "pilot"), F.col("n")))
    slots = index.slots.withColumnRenamed("digest", "held")
    at = at.withColumn("slot", slot).join(slots, ["shard", "slot"], "left")
    same = F.coalesce(F.col("digest") == F.col("held"), F.lit(False))
    own = [F.col("row")[c].alias(c) for c in rows.columns if c not in ("winner", "copies", "__member")]
    return at.select(*own, F.when(same, F.col("winner")).alias("winner"), F.when(same, F.col("copies")).alias("copies"), same.alias("__member"))


def exact_groups(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id_col, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after white space runs become one space; null is empty. ``known`` is a history of
    distinct digests (``digest, winner, copies``), for example of earlier batches; without one, it is made of the
    digests that occur more than once in ``docs`` itself. Members of the history take its winner and its count; rows
    whose digest it doesn't hold form their own groups, whose smallest id stays. Null ids lose against any other
    id; a group with null ids only has a null ``keep_id`` and keeps its rows. Rows repeated with one id share their fate.
    """
    keyed = staged(docs.select(F.col(id_col).alias("__id"), digest_of(F.col(text_col)).alias("digest")), "keyed")
    counted = lambda rows: rows.groupBy("digest").agg(F.min("__id").alias("winner"), F.count(F.lit(1)).alias("copies"))
    history = counted(keyed).where("copies > 1") if known is None else known
    found = staged(lookup(keyed, build_index(history)), "found")
    members = found.where("__member").select("__id", "digest", "winner", "copies")
    others = found.where("not __member").select("__id", "digest")
    others = others.join(counted(others), "digest").select("__id", "digest", "winner", "copies")
    return members.unionByName(others).select(
        F.col("__id").alias(id_col),
        F.col("winner").alias("keep_id"),
        F.col("copies").alias("group_size"),
        F.col("__id").eqNullSafe(F.col("winner")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def deduplicated(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, that stay in their group. Rows repeated with one id share their fate."""
    groups = exact_groups(docs, known, id_col, text_col)
    stay = groups.where("kept").select(F.col(id_col).alias("__stays"), F.unhex("text_sha256").alias("__digest")).distinct()
    return docs.join(stay, docs[id_col].eqNullSafe(stay["__stays"]) & (digest_of(docs[text_col]) == stay["__digest"]), "left_semi")
