import hashlib
import random
import re

from tests.llm.helpers import documents, frame
from touchline.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def brute(rows, items, k):
    windows = {}
    for item, text in items:
        w = words(text)
        if w and item is not None:
            n = min(k, len(w))
            for i in range(len(w) - n + 1):
                windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    out = []
    for doc, text in rows:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if own := windows.get(tuple(w[i : i + n])):
                    hit |= set(range(i, i + n))
                    found |= own
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def bench(spark, items):
    return spark.createDataFrame([(i, t, "e") for i, t in items], "item_id long, text string, __id string")


def test_windows(spark):
    rows = documents()
    rnd = random.Random(7)
    texts = [t for _, t in rows if t and t.split()]
    items = []
    for i in range(25):
        w = rnd.choice(texts).split()
        at = rnd.randrange(len(w))
        items.append((i, " ".join(w[at : at + rnd.randint(1, 30)]).upper() if i % 3 else " ".join(w[at : at + 14]) + " unseen words"))
    items += [(40, None), (41, ""), (42, "!!"), (None, "one"), (43, "One"), (44, "never seen anywhere"), (43, "One")]
    rows += [(300, "again"), (300, rows[12][1]), (300, rows[12][1]), (None, rows[12][1])]
    got = sorted(map(tuple, decontam.contamination(frame(spark, rows), bench(spark, items)).drop("items").collect()), key=str)
    want = brute(rows, items, 10)
    assert got == want and sum(r[-1] for r in got) > 5


def test_empty_tables(spark):
    assert decontam.contamination(frame(spark, []), bench(spark, [(1, "a b")])).count() == 0
    assert not any(r.contaminated for r in decontam.contamination(frame(spark, [(1, "a b"), (2, None)]), bench(spark, [])).collect())


def test_proximity(spark):
    rows = [(1, "zeta filler filler alpha filler beta"), (2, "alpha " + "filler " * 30 + "beta zeta"), (3, "beta alpha zeta"), (4, "alpha only")]
    items = [(9, "alpha beta zeta filler")]
    got = {(r.doc_id, r.item, r.first, r.last) for r in decontam.proximity_matches(frame(spark, rows), bench(spark, items), terms=3, within=6).collect()}
    assert got == {(1, "9", 0, 5), (3, "9", 0, 2)}


def test_no_python_in_the_plan(spark, sf):
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    plan = decontam.contamination(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_items_that_share_an_id_but_not_the_text(spark):
    texts = ["alpha beta gamma delta", "one two three four five six", "single", "beta alpha"]
    rows = [(i, f"filler {t} filler") for i, t in enumerate(texts)] + [(9, "alpha two gamma")]
    items = [(7, t) for t in texts]
    for k in (3, 10):
        got = sorted(map(tuple, decontam.contamination(frame(spark, rows), bench(spark, items), k).drop("items").collect()), key=str)
        assert got == brute(rows, items, k)
        assert [r[-1] for r in got] == [True] * 4 + [False]
