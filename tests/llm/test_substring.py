import hashlib
import re

import pytest
from tests.llm.helpers import documents, frame
from touchline.llm import substring


def brute(rows, k):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    for (i, _), w in zip(rows, words, strict=True):
        if i is not None:
            for p in range(len(w) - k + 1):
                g = tuple(w[p : p + k])
                first[g] = min(first.get(g, i), i)
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = {p + j for p in range(len(w) - k + 1) if i is not None and first[tuple(w[p : p + k])] < i for j in range(k)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(map(tuple, df.drop("kept_text").collect()), key=str)


def test_repeats(spark):
    rows = documents()
    long = next(t for _, t in rows if t and len(t.split()) == 6000)
    rows += [(200, long + " end"), (201, long), (201, long), (201, "other text " + long[:500]), (None, long), (None, None)]
    got = result(substring.remove_repeats(frame(spark, rows)))
    assert got == brute(rows, 13)
    assert sum(r[2] for r in got) > 12000
    assert substring.remove_repeats(frame(spark, [])).count() == 0


def test_equal_texts_around_the_window(spark):
    """Equal texts of 1 to 14 words beside long ones: only those with a window repeat each other."""
    words = [f"w{i}" for i in range(300)]
    rows = [(10 * n + k, " ".join(words[20 * n : 20 * n + n])) for n in range(15) for k in range(3)]
    rows += [(500, " ".join(words)), (501, " ".join(words)), (502, "That it."), (503, "That it."), (504, " \n "), (505, " \n ")]
    got = result(substring.remove_repeats(frame(spark, rows)))
    assert got == brute(rows, 13)
    assert [r[2] for r in got if r[0] in (122, 132, 501, 503)] == [0, 13, 300, 0]


def test_short_windows_and_loops(spark):
    rows = [(1, "a b c d e f g h"), (2, "a b c d e x a b c d e"), (3, "a a a a a a a a"), (4, "a a a a a a b"), (5, "q a b c d e f g h z")]
    assert result(substring.remove_repeats(frame(spark, rows), window=5, anchor=2)) == brute(rows, 5)


def spans(spark, rows, **more):
    return substring.repeated_spans(substring.keyed_rows(frame(spark, rows), "doc_id", "text"), **more).collect()


def test_spans_name_their_source(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    (span,) = spans(spark, [(4, "x y " + passage), (9, passage + " z")])
    assert (span["__id"], span.start, span.n, span.sid, span.sstart) == (9, 0, 60, 4, 2)


def test_paths_end_where_the_graph_branches(spark):
    """Two documents repeat a passage and go on in two ways that others repeat: one path to the fork, one for each way."""
    head, ways = [f"p{i}" for i in range(30)], [[f"{c}{i}" for i in range(20)] for c in "xy"]
    texts = [(k, " ".join(head + ways[k % 2])) for k in range(1, 5)]
    texts[2] = (3, texts[2][1] + " other")
    texts[3] = (4, "other " + texts[3][1])
    got = {(r["__id"], r.start, r.n, r.sid, r.sstart) for r in spans(spark, texts)}
    # The fork's node is the passage's last 12 words: the edge into it is the last of the first path.
    assert got == {(2, 0, 30, 1, 0), (3, 0, 30, 1, 0), (3, 18, 32, 1, 18), (4, 1, 30, 1, 0), (4, 19, 32, 2, 18)}


@pytest.mark.parametrize("bits", [1, 6, 12])
def test_words_whose_hashes_meet_by_chance_are_kept(spark, bits):
    rows = documents(n=25)
    assert result(substring.remove_repeats(frame(spark, rows), bits=bits)) == brute(rows, 13)


def test_many_anchors_and_hot_edges(spark, monkeypatch):
    """Windows picked by a join instead of the bitmap, and edges joined by broadcast, give the same."""
    rows = documents()
    for name, value in (("FILTER_ANCHORS", 0), ("HOT_ROWS", 2), ("HOT_SHARE", 10**9), ("BROADCAST_GROUPS", 0)):
        monkeypatch.setattr(substring, name, value)
    assert result(substring.remove_repeats(frame(spark, rows))) == brute(rows, 13)
