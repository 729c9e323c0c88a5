import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F
from tests.llm.helpers import documents, frame
from touchline.llm import exact


def brute(rows):
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    groups = {}
    for i, t in norm:
        groups.setdefault(t, []).append(i)
    out = []
    for i, t in norm:
        ids = [x for x in groups[t] if x is not None]
        keep = min(ids, default=None)
        out.append((i, keep, len(groups[t]), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def test_groups(spark):
    rows = documents() + [(None, "One"), (90, "twice"), (90, "twice"), (None, "only null")]
    assert sorted(map(tuple, exact.exact_groups(frame(spark, rows)).collect()), key=str) == brute(rows)
    assert exact.exact_groups(frame(spark, [])).count() == 0


def test_hash_is_minimal_and_perfect():
    rnd = random.Random(3)
    for n in (1, 2, 3, 10, 500):
        keys = [rnd.randbytes(32) for _ in range(n)]
        pilots, slots = exact.place_keys(keys, [int.from_bytes(k[:4]) % (n // 4 + 1) for k in keys])
        assert sorted(slots) == list(range(n))
        assert all(s == (-1 - p if p < 0 else exact.slot_hash(k, p, n)) for k, p, s in zip(keys, pilots, slots, strict=True))


def test_history_of_earlier_batches(spark):
    from pyspark.sql import functions as F

    old = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    known = old.select(exact.digest_of(F.col("text")).alias("digest"), F.col("doc_id").alias("winner"), F.lit(1).alias("copies"))
    new = spark.createDataFrame([(7, "a  b"), (8, "new"), (9, "new")], "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.kept) for r in exact.exact_groups(new, known).collect()}
    assert got == {7: (1, False), 8: (8, True), 9: (8, False)}


def test_known_digests_that_repeat_or_are_null(spark):
    docs = frame(spark, [(1, "a"), (2, "b"), (3, "a"), (4, None)])
    digest = docs.select(exact.digest_of(F.col("text")).alias("digest")).where("doc_id = 1")
    known = digest.select("digest", F.lit(90).cast("long").alias("winner"), F.lit(2).alias("copies"))
    known = known.unionByName(known.withColumn("winner", F.lit(80).cast("long"))).unionByName(known.withColumn("digest", F.lit(None).cast("binary")))
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact.exact_groups(docs, known).collect()}
    assert got == {1: (80, 4), 3: (80, 4), 2: (2, 1), 4: (4, 1)}
    with pytest.raises(ValueError, match="distinct"):
        exact.place_keys([b"x", b"x"], [0, 0])


def test_lookup_replaces_columns_of_its_names(spark):
    rows = frame(spark, [(1, "a"), (2, "b")]).withColumn("digest", exact.digest_of(F.col("text"))).withColumn("slot", F.lit(5))
    index = exact.build_index(rows.select("digest", F.col("doc_id").alias("winner"), F.lit(1).alias("copies")).where("winner = 1"))
    got = {r.doc_id: (r.winner, r.copies, r["__member"], r.slot) for r in exact.lookup(rows, index).collect()}
    assert got == {1: (1, 1, True, 5), 2: (None, None, False, 5)}
