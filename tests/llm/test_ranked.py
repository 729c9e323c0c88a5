import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from tests.llm.helpers import documents, frame
from touchline.llm import ranked


def terms_of(text):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(ranked.TERM, lower)


def brute(rows, items, top):
    docs = [(i, Counter(terms_of(t))) for i, t in rows]
    n_docs, n_words = sum(bool(c) for _, c in docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    asked = defaultdict(set)
    for i, t in items:
        if i is not None:
            asked[i] |= set(terms_of(t))
    out = []
    for item, terms in asked.items():
        found = []
        for i, c in docs:
            m = 50 + 50 * sum(c.values()) * n_docs // max(n_words, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if score > 0:
                found.append((-score, i is None, i or 0))
        for rank, (score, none, i) in enumerate(sorted(found)[:top], 1):
            out.append((item, rank, None if none else i, -score))
    return sorted(out, key=str)


def case():
    rows = documents()
    rnd = random.Random(4)
    items = [(k, " ".join(rnd.sample(sorted({t for _, text in rows for t in terms_of(text)}), rnd.randint(1, 30)))) for k in range(25)]
    items += [(90, None), (91, ""), (92, "nowhere-at-all qqq"), (None, "the one"), (93, "ONE one Ünï"), (94, rows[30][1]), (94, rows[31][1]), (95, "in " * 30)]
    rows += [(300, "One"), (301, "one"), (301, "one"), (None, "one one"), (302, "a1 2b,one")]
    return rows, items


def result(spark, rows, items, top, **more):
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    return sorted(map(tuple, ranked.ranked_search(frame(spark, rows), asked, top, **more).collect()), key=str)


@pytest.mark.parametrize(("block_docs", "top"), [(7, 5), (ranked.BLOCK_DOCS, 50), (64, 1)])
def test_search(spark, block_docs, top):
    rows, items = case()
    assert result(spark, rows, items, top, block_docs=block_docs) == brute(rows, items, top)


def test_many_passes_and_small_blocks(spark, monkeypatch):
    rows, items = case()
    for name, value in (("PASS_TERMS", 100), ("BLOCK_POSTINGS", 50), ("FEW", 2), ("KEPT_TERMS", 3)):
        monkeypatch.setattr(ranked, name, value)
    assert result(spark, rows, items, 10) == brute(rows, items, 10)


def test_empty_tables(spark):
    rows, items = case()
    assert result(spark, [], items, 5) == [] and result(spark, rows, [], 5) == []
    assert result(spark, [(1, None), (2, "--")], items, 5) == []


def test_string_ids(spark):
    docs = spark.createDataFrame([("b", "apple pie"), ("a", "apple pie"), ("c", "pie")], "doc_id string, text string")
    asked = spark.createDataFrame([("q", "Apple")], "item_id string, text string")
    assert [(r.item_id, r.rank, r.doc_id) for r in ranked.ranked_search(docs, asked, 5).collect()] == [("q", 1, "a"), ("q", 2, "b")]


def test_sums_and_tops_of_slices():
    rng = np.random.default_rng(5)
    for n, top in ((1, 1), (63, 5), (64, 64), (1000, 50), (130, 200)):
        words = -(-n // 64)
        columns = [rng.integers(0, 1 << rng.integers(1, 30), n) * (rng.random(n) < p) for p in (0.01, 0.5, 1.0, 0.9, 0.02, 1.0)]
        maps = []
        for v in columns:
            slots = np.flatnonzero(v)
            width = int(v.max()).bit_length()
            bits = np.packbits((v[slots] >> np.arange(width)[:, None] & 1).astype(np.uint8), axis=1, bitorder="little").tobytes()
            maps += [ranked.laid_out(bits, width, slots, words)] if width else []
        sums = ranked.added(maps, 40, words)
        total = sum(columns)
        got = [int(sum(int(sums[b, s >> 6] >> np.uint64(s & 63)) % 2 << b for b in range(40))) for s in range(n)]
        assert got == total.tolist()
        want = [s for s in sorted(range(n), key=lambda s: (-total[s], s)) if total[s] > 0][:top]
        assert sorted(ranked.top_slots(sums, top).tolist()) == sorted(want)
