import random

import numpy as np
import pytest
import xxhash
from tests.llm.helpers import documents, frame
from touchline.llm import simhash


def fingerprint(text):
    w = [x for x in (text or "").translate({i: i + 32 for i in range(65, 91)}).encode().split()]
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(rows, radius):
    fps = [(i, fingerprint(t)) for i, t in rows]
    up = list(range(len(fps)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a][1] ^ fps[b][1]).bit_count() <= radius:
                up[root(a)] = root(b)
    low = {}
    for k, (i, _) in enumerate(fps):
        low[root(k)] = min(x for x in (i, low.get(root(k))) if x is not None)
    return sorted((i, f"{f:016x}", low[root(k)]) for k, (i, f) in enumerate(fps))


def test_components(spark):
    for radius in (4, 12):
        rows = documents()
        assert sorted(map(tuple, simhash.fingerprint_components(frame(spark, rows), radius).collect())) == components(rows, radius)
    assert simhash.fingerprint_components(frame(spark, [])).count() == 0
    assert {r.component_id for r in simhash.fingerprint_components(frame(spark, [(5, "x"), (None, "x"), (5, "x")])).collect()} == {5}


def test_tree_links_connect_what_all_pairs_connect(monkeypatch):
    rnd = random.Random(2)
    for spread, n in ((3, 300), (64, 500), (10, 700)):
        base = [rnd.getrandbits(64) for _ in range(5)]
        fps = np.array([[b ^ sum(1 << rnd.randrange(64) for _ in range(rnd.randrange(spread)))] for b in rnd.choices(base, k=n)], dtype=object)
        fps = np.array([[int(x[0]) & (1 << 64) - 1] for x in fps], np.uint64)
        want, got = simhash.Groups(n), simhash.Groups(n)
        shard = np.sort(np.array(rnd.choices(range(3), k=n)))
        for i in range(n):
            for j in range(i):
                if shard[i] == shard[j] and int(np.bitwise_count(fps[i] ^ fps[j])[0]) <= 4:
                    want.join(i, j)
        monkeypatch.setattr(simhash, "QUERIES", 100)
        parent, edge = simhash.bk_forest(fps, shard)
        assert (parent < 0).sum() == 3 and (simhash.hamming(fps, fps[parent])[parent >= 0] == edge[parent >= 0]).all()
        assert len({(p, e) for p, e in zip(parent.tolist(), edge.tolist(), strict=True) if p >= 0}) == n - 3  # an edge, a child
        links = list(zip(*(x.tolist() for x in simhash.bk_links(fps, shard, 4)), strict=True))
        assert len(links) < n
        for i, j in links:
            assert shard[i] == shard[j]
            got.join(i, j)
        assert [want.root(i) for i in range(n)] == [got.root(i) for i in range(n)]


def test_blocks_lose_no_pair_within_the_radius(spark):
    rnd = random.Random(4)
    for n in (10, 10**7, 10**10):
        pairs = []
        for k in range(60):
            x = rnd.getrandbits(64)
            y = x
            for b in rnd.sample(range(64), 4):
                y ^= 1 << b
            pairs += [(2 * k, x.to_bytes(8)), (2 * k + 1, y.to_bytes(8))]
        got = simhash.block_shards(spark.createDataFrame(pairs, "__id long, __fp binary"), n, 4).collect()
        keys = {}
        for r in got:
            keys.setdefault(r["__id"], set()).add(r["__key"])
        assert all(keys[2 * k] & keys[2 * k + 1] for k in range(60))


def test_near_groups(spark):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    clean = [" ".join(rnd.choices(words, k=150)) for _ in range(40)]
    near = []
    for t in clean[:10]:
        w = t.split()
        w[70] = "other"
        near.append(" ".join(w))
    rows = list(enumerate([*clean, *near, "", None, "short", "short words"]))
    got = {r.doc_id: r.group_id for r in simhash.near_groups(frame(spark, rows)).collect()}
    assert got == {i: i % 40 for i in [*range(10), *range(40, 50)]}
    assert simhash.near_groups(frame(spark, [])).count() == 0


def test_rows_that_share_an_id_are_judged_by_their_own_text(spark):
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    base = " ".join(rnd.choices(words, k=150))
    rows = [(1, base), (2, base + " more"), (2, "an unrelated document that shares an id"), (3, base + " most"), (3, base + " most"), (None, base), (None, base + " more")]
    docs = frame(spark, rows)
    left = simhash.without_near_copies(docs)
    assert left.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted([rows[0], rows[2], rows[5], rows[6]], key=str)
    assert simhash.without_near_copies(frame(spark, [])).count() == 0


def test_large_shards_lose_no_link(spark, monkeypatch):
    """Shards far over the bound: a dense group, its fringe, and rows that are far from each other."""
    rnd = random.Random(6)
    base = rnd.getrandbits(64)
    flip = lambda x, most: x ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(most)))
    values = list({*(flip(base, 4) for _ in range(60)), *(flip(base, 9) for _ in range(60)), *(rnd.getrandbits(64) for _ in range(60))})
    fps = np.array(values, np.uint64)[:, None]
    want = simhash.Groups(len(values))
    for i in range(len(values)):
        for j in np.flatnonzero(simhash.hamming(fps[:i], fps[i]) <= 4).tolist():
            want.join(i, j)
    monkeypatch.setattr(simhash, "SHARD_MOST", 16)
    shards = spark.createDataFrame([(7, v.to_bytes(8), i) for i, v in enumerate(values)], "__key long, __fp binary, __id int")
    for rounds in (0, 1, 4):
        monkeypatch.setattr(simhash, "LEADER_ROUNDS", rounds)
        got = simhash.Groups(len(values))
        for r in simhash._links(shards, 4, 1).collect():
            got.join(r.a, r.b)
        assert [want.root(i) for i in range(len(values))] == [got.root(i) for i in range(len(values))]


def jaccard(a, b, k=5):
    sets = [{tuple(w[i : i + k]) for i in range(len(w) - k + 1)} for w in (a.split(), b.split())]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


@pytest.mark.parametrize("most", [1024, 16])
def test_near_groups_on_both_sides_of_the_similarity(spark, monkeypatch, most):
    """Pairs at 0.8 are linked, pairs just below are not; with small shards also one group whose copies share a text."""
    monkeypatch.setattr(simhash, "SHARD_MOST", most)
    rows, want = [], {}
    for k in range(120):
        w = [f"d{k}w{j}" for j in range(164)]
        more = 40 + k % 2 * (1 + k // 2 % 12)  # even: 160 of 200 shingles; odd: 160 of 201 to 212
        a, b = " ".join(w), " ".join(w + [f"d{k}x{j}" for j in range(more)])
        assert (jaccard(a, b) >= 0.8) == (k % 2 == 0)
        rows += [(2 * k, a), (2 * k + 1, b)]
        if k % 2 == 0:
            want |= {2 * k: 2 * k, 2 * k + 1: 2 * k}
    shared = [f"s{j}" for j in range(104)]  # 100 shingles, and 6 to 38 more of its own for each of 60 rows
    star = {1000 + i: " ".join(shared + [f"s{i}y{j}" for j in range(6 + 2 * (i % 17))]) for i in range(60)}
    groups = simhash.Groups(60)
    for i in range(60):
        for j in range(i):
            if jaccard(star[1000 + i], star[1000 + j]) >= 0.8:
                groups.join(i, j)
    roots = [groups.root(i) for i in range(60)]
    want |= {1000 + i: 1000 + r for i, r in enumerate(roots) if roots.count(r) > 1}
    assert 0 < len(want) - 120 < 60
    got = {r.doc_id: r.group_id for r in simhash.near_groups(frame(spark, [*rows, *star.items()])).collect()}
    assert got == want
