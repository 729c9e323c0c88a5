import re

import pytest
from tests.llm.helpers import frame
import corpus_pipeline
from touchline.llm.common import staged


def shingles(text, k=5):
    w = text.lower().split()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def words(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate({i: i + 32 for i in range(65, 91)})) if w]


@pytest.fixture(scope="module")
def stages(spark, sf):
    out, docs = {}, spark.read.parquet(f"{sf}/documents.parquet")
    out["input"] = docs
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = staged(stage(spark, docs, sf), "test-stage")
    return {k: v.toPandas() for k, v in out.items()}


def test_columns_and_order(stages):
    names = list(stages)
    for a, b in zip(names, names[1:-1], strict=False):
        assert list(stages[b].columns) == list(stages["input"].columns)
        assert set(stages[b].doc_id) <= set(stages[a].doc_id)


def test_exact(stages):
    low = {}
    for i, t in zip(stages["toxicity"].doc_id, stages["toxicity"].text, strict=True):
        key = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        low[key] = min(i, low.get(key, i))
    assert set(stages["exact dedup"].doc_id) == set(low.values())


def test_near(stages):
    docs = stages["exact dedup"]
    sets = {i: shingles(t or "") for i, t in zip(docs.doc_id, docs.text, strict=True)}
    ids, kept = sorted(sets), set(stages["SimHash near-dedup"].doc_id)
    best, must_go = dict.fromkeys(ids, 0.0), set()
    for x, i in enumerate(ids):
        for j in ids[:x]:
            if sets[i] and sets[j]:
                s = len(sets[i] & sets[j]) / len(sets[i] | sets[j])
                best[i] = max(best[i], s)
                if s >= 0.8:
                    must_go.add(i)
    assert not must_go & kept
    assert {i for i in ids if best[i] < 0.8} <= kept


def test_decontamination(stages, spark, sf):
    items = [words(t or "") for t in spark.read.parquet(f"{sf}/benchmark.parquet").toPandas().text]
    windows = {tuple(w[i : i + 10]) for w in items if w for i in range(max(1, len(w) - 9))}
    sizes = {len(w) for w in windows}
    docs = stages["SimHash near-dedup"]
    hit = {i for i, t in zip(docs.doc_id, docs.text, strict=True) for w in [words(t or "")] if any(tuple(w[k : k + n]) in windows for n in sizes for k in range(len(w) - n + 1))}
    assert set(docs.doc_id) - hit == set(stages["benchmark decontamination"].doc_id)


def test_packing(stages):
    packed = stages["best-fit packing"]
    assert set(packed.doc_id) == set(stages["benchmark decontamination"].doc_id)
    for _, rows in packed.sort_values("offset").groupby("sequence_id"):
        at = 0
        for r in rows.itertuples():
            assert r.offset == at
            at += r.length
        assert at <= 2048


def test_nulls_repeated_rows_and_empty_tables(spark, sf):
    rows = [(1, "a b c"), (1, "a b c"), (None, "a b c"), (2, None), (3, None), (4, ""), (None, None), (5, "x y " * 400)]
    for docs in (frame(spark, rows), frame(spark, [])):
        for _, stage in corpus_pipeline.STAGES:
            docs = staged(stage(spark, docs, sf), "test-stage")
        docs.collect()
