import re
from collections import defaultdict
from fractions import Fraction
from hashlib import md5

import pytest
from tests.llm.helpers import documents
from touchline.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, target string, __hash string, mix int"


def frame(spark, rows):
    """Rows (id, text, source) with extra columns whose names the operator uses inside."""
    return spark.createDataFrame([(i, t, "en", s, 1, 2, "x", "y", 5) for i, t, s in rows], SCHEMA).repartition(3)


def sourced():
    rows = documents()
    names = ["b", "a", None, "b", "é", "b", "b", "zz", "a10", "a9"]
    out = [(i, t, names[i % 10]) for i, t in rows]
    return [*out, (900, "one two", "tiny"), (901, None, "none"), (902, "", "none"), (903, "x y z", "Z")]


def brute(rows, weights=(1, 2, 3), most=3):
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    key = lambda i, t: int(md5(f"{'null' if i is None else i}|{t or ''}".encode()).hexdigest()[:15], 16)
    by = defaultdict(list)
    for i, t, s in rows:
        by[s].append((key(i, t), words(t), i))
    order = sorted(by, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total = {s: sum(x[1] for x in by[s]) for s in order}
    left, open_, target = Fraction(sum(total.values())), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if weight[s] * level > most * total[s]}
        if not above:
            target |= {s: float(weight[s] * level) for s in open_}
            break
        for s in above:
            target[s] = float(most * total[s])
            left -= most * total[s]
        open_ -= above
    out = []
    for s in order:
        repeats = int(target[s] // total[s]) if total[s] else 0
        need, run, cut = target[s] - repeats * total[s], 0, -1
        sizes = defaultdict(int)
        for h, n, _ in by[s]:
            sizes[h] += n
        for h in sorted(sizes):
            if run + sizes[h] > need:
                cut = h if need - run > sizes[h] / 2 else cut
                break
            run, cut = run + sizes[h], h
        out += [(i, n, total[s], target[s], n * (repeats + (h <= cut))) for h, n, i in by[s]]
    return out


def rows_of(df):
    return sorted(((*r[:3], round(r[3], 6), r[4]) for r in df.collect()), key=str)


def expected(rows, **more):
    return sorted(((*r[:3], round(r[3], 6), r[4]) for r in brute(rows, **more)), key=str)


@pytest.mark.parametrize("bits", [12, 3])
def test_mix(spark, monkeypatch, bits):
    """With few bits a level, the boundary bucket is refined many times."""
    monkeypatch.setattr(mixing, "LEVEL_BITS", bits)
    rows = sourced()
    rows += [rows[5], rows[5], (None, "without an id", "b"), (None, None, None)]
    got = rows_of(mixing.mixed_sources(frame(spark, rows)))
    assert got == expected(rows)
    assert rows_of(mixing.mixed_sources(frame(spark, rows[::-1]))) == got


def test_near_targets_and_bounds(spark):
    rows = sourced() + [(1000 + i, "w " * (i % 40 + 1), f"s{i % 7 if i % 3 else 0}") for i in range(2000)]
    own = {r.doc_id: r for r in mixing.mixed_sources(frame(spark, rows)).collect()}
    by = defaultdict(list)
    for i, _, s in rows:
        by[s].append(own[i])
    for group in by.values():
        assert abs(sum(r.taken for r in group) - group[0].target) <= max(r["size"] for r in group) / 2 + 1e-6
        assert all(r.taken <= 3 * r["size"] for r in group)
        assert group[0].target <= 3 * group[0].source_size


def test_mixes_are_nested(spark):
    for r in mixing.nested_mixes(frame(spark, sourced()), (0.1, 0.35, 0.5, 1.0, 2.0)).collect():
        taken = [m.taken for m in r.mixes]
        assert taken == sorted(taken) and len(taken) == 5


def test_empty(spark):
    assert mixing.mixed_sources(frame(spark, [])).collect() == []
    assert rows_of(mixing.mixed_sources(frame(spark, [(1, None, None), (2, "", "a")]))) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
