import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from tests.llm.helpers import documents
from touchline.llm import audit, bytescan

SCHEMA = "doc_id long, text string, lang string, source string, mask int, words string, part int, n long"
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, p, "s", 1, "x", 2, 3) for i, t, p in rows], SCHEMA).repartition(3)


def cases():
    langs = ["en", "", None, "de", "en", "en"]
    rows = [(i, t if t is None or i % 4 else t + " A#B", langs[i % 6]) for i, t in documents()]
    long = " ".join(f"w{i}" for i in range(250))
    rows += [(500, long, "en"), (501, long, "xx"), (502, long + " $", "en"), (503, "a " * 300, "en"), (504, "a " * 300, "en"), (505, "ABC é" * 300, "de"), (None, long, "en"), (None, None, None), (506, long, "en"), (506, long, "en"), (3, long, "de")]
    labels = [(i, int(i % 3 > 0), int(i % 5 == 0)) for i in range(3, 90)] + [(500, None, 1), (501, 1, 1), (501, 0, None), (None, 1, 1), (7777, 1, 1)]
    return rows, labels


def masks(rows):
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    for i, t, p in rows:
        text = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), bool(re.search(r"[#$%&*|]", text)), i is not None and first[text] < i)
        yield i, p or "", frozenset(f for f, x in zip("ABCDE", fails, strict=True) if x)


def brute(rows, labels):
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, x in labels if x == 1 and i is not None}
    docs, out = list(masks(rows)), {}
    for part in {p for _, p, _ in docs}:
        own = [(i, f) for i, p, f in docs if p == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            gone = [False] * len(own)
            for step, letter in enumerate(order, 1):
                c = dict.fromkeys(COUNTS, 0)
                for k, (i, f) in enumerate(own):
                    if letter in f:
                        c["unique_fails"] += f == {letter}
                        if gone[k]:
                            c["redundant"] += 1
                        else:
                            gone[k] = True
                            c["removed"] += 1
                            c["good_lost"] += i in good
                            c["toxic_lost"] += i in toxic
                c["kept"] = gone.count(False)
                shapley[letter] += c["removed"]
                out[part, "".join(order), step] = c
        for (p, order, step), c in out.items():
            if p == part:
                c["shapley"] = shapley[order[step - 1]]
    return out


def test_audit(spark):
    rows, labels = cases()
    got = audit.filter_audit(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert {(r.part, r.filter_order, r.step): {c: r[c] for c in COUNTS} for r in got} == brute(rows, labels)
    assert len(got) == 600 * len({r.part for r in got})


def test_large_groups_and_shuffled_joins(spark, monkeypatch):
    rows, _ = cases()
    for name, value in (("HOT_ROWS", 2), ("HOT_SHARE", 10**9), ("BROADCAST_ROWS", 0)):
        monkeypatch.setattr(audit, name, value)
    got = Counter((r["__id"], r["__part"], r["mask"]) for r in audit.filter_failures(frame(spark, rows)).collect())
    assert got == Counter((i, p, sum(1 << "ABCDE".index(x) for x in f)) for i, p, f in masks(rows))


@pytest.mark.parametrize("bits", [1, 5, 64])
def test_counts_of_words(bits):
    """Distinct words are exact however few bits tell the words' hashes apart."""
    texts = pa.array(["", " ", "a", " a", "a\x0b", *((t or "") for _, t in documents()), "", "x\x1cy x\x1cy  "]).slice(1)
    data, starts = bytescan.text_bytes(texts)
    first, last = bytescan.word_bounds((bytescan.CLASSES[data] & bytescan.SPACE) > 0, starts)
    words = [re.findall(r"[^\x20\x09-\x0D]+", t.as_py()) for t in texts]
    assert bytescan.word_counts(texts).tolist() == [len(w) for w in words]
    assert audit.distinct_words(data, starts, first, last, bits).tolist() == [len(set(w)) for w in words]
    assert [data[a:b].tobytes().decode() for a, b in zip(first, last, strict=True)] == [x for w in words for x in w]


def test_hash_is_of_the_word_alone():
    data = np.frombuffer(b"ab xab ab ba", np.uint8)
    h = audit.word_hashes(data, np.array([0, 3, 7, 10]), np.array([2, 6, 9, 12]))
    assert h[0] == h[2] and len(set(h.tolist())) == 3


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.filter_audit(frame(spark, []), none).collect() == []
    got = audit.filter_audit(frame(spark, [(1, None, None)]), none).collect()
    assert len(got) == 600 and {r.part for r in got} == {""} and sum(r.removed for r in got) == 120
    assert defaultdict(int, {r.filter_order[r.step - 1]: r.shapley for r in got})["A"] == 120
