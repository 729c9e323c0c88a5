import random
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F
from tests.llm.helpers import documents, frame
from touchline.llm import toxicity


def brute(scores):
    """Maximal segments by their definition: split around the best segment, again and again."""
    best = max(((sum(scores[a:b]), -(b - a), a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=(0, 0, 0, 0))
    if best[0] <= 0:
        return []
    _, _, a, b = best
    return [(x, y) for x, y in brute(scores[:a])] + [(a, b)] + [(x + b, y + b) for x, y in brute(scores[b:])]


def test_segments():
    rnd = random.Random(1)
    for _ in range(200):
        s = [rnd.choice([-3, -2, -1, 1.25, 2.5]) + rnd.random() / 100 for _ in range(rnd.randint(0, 14))]
        assert [(a, b) for a, b, _ in toxicity.maximal_segments(np.array(s))] == brute(s)


def test_held_out_accuracy(spark, sf):
    sf = sf.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = toxicity.scored(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    held = got[got.held_out]
    assert (held.predicted == held.toxic).mean() >= 0.95
    pos, neg = held[held.toxic == 1].score.to_numpy(), held[held.toxic == 0].score.to_numpy()
    auc = (pos[:, None] > neg[None, :]).mean() + 0.5 * (pos[:, None] == neg[None, :]).mean()
    assert auc >= 0.8, auc  # a few labels are wrong on purpose


def test_edges(spark):
    docs = frame(spark, [*documents(), (None, "no id"), (99, None)])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.scored(docs, none).collect()
    assert all(0 <= r.score < 0.5 and r.predicted == 0 for r in got) and len(got) == docs.count()
    ids = [r.doc_id for r in docs.where("doc_id % 2 = 0").select("doc_id").collect()]
    some = spark.createDataFrame([(i, i % 4 // 2) for i in ids] + [(ids[0], None), (None, 1)], "doc_id long, toxic int")
    assert toxicity.scored(docs, some).count() == docs.count()
    assert toxicity.scored(docs.where("false"), some).count() == 0


def test_passages(spark):
    words = [f"w{i}" for i in range(200)]
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choices(words, k=60)) + (" you nasty nasty fool " if i % 4 == 0 else " ") + " ".join(rnd.choices(words, k=60))) for i in range(200)]
    docs = frame(spark, rows)
    model = toxicity.fit(docs, docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic")), hold_out=False)
    found = toxicity.toxic_passages(docs, model).collect()
    assert {r.doc_id for r in found} == {i for i in range(200) if i % 4 == 0}
    assert all(60 <= r.first_word <= 62 and r.first_word + r.n_words <= 64 for r in found)


def test_units_that_share_twenty_bits_are_counted_apart(spark):
    """A toxic word and a word of every clean document whose hashes agree on their last 20 bits."""
    toxic, clean = "qal8", "the"
    assert (xxhash.xxh64_intdigest(toxic.encode()) ^ xxhash.xxh64_intdigest(clean.encode())) % (1 << 20) == 0
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(rnd.choices(words, k=40) + [toxic if i % 4 == 0 else clean] * 3 + rnd.choices(words, k=40))) for i in range(200)]
    docs = frame(spark, rows)
    model = toxicity.fit(docs, docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic")), hold_out=False)
    of_toxic, of_clean = model.scores.of(*toxicity.Units().of([toxic.encode(), clean.encode()], np.ones(2)))
    assert of_toxic > 0 > of_clean
    assert {r.doc_id for r in toxicity.toxic_passages(docs, model).collect()} == {i for i in range(200) if i % 4 == 0}


def test_counts_by_unit_are_whole(spark, monkeypatch):
    """However often a task hands on its counts, they sum to those of a plain count."""
    rows = [("One word, one wordy WORD", 1), ("words of mine", 2), ("one", None), ("", 1), (None, None), ("\u00dcmlaut word", 8), ("  one ", 2)]
    want = {}
    for text, kind in rows:
        for u in {u for w in (text or "").encode().split() for u in toxicity.unit_hashes(w)}:
            for k in {0, kind or 0}:
                want[u, k] = want.get((u, k), 0) + 1
    for most in (1, 1 << 20):
        monkeypatch.setattr(toxicity, "HELD_UNITS", most)
        got = {}
        for b in toxicity._document_counts([pa.RecordBatch.from_pydict({"__text": [t for t, _ in rows], "kind": pa.array([x for _, x in rows], pa.int32())})] * 2):
            for r in b.to_pylist():
                key = r["unit"] % (1 << 64), r["kind"]
                got[key] = got.get(key, 0) + r["docs"]
        assert got == {k: 2 * n for k, n in want.items()}


def test_model_and_scores_equal_a_plain_count(spark, monkeypatch):
    """Log-odds, deviations, lambda, K, curve and scores, computed one text after the other."""
    monkeypatch.setattr(toxicity, "LEAST_Z", 1.0)
    rnd = random.Random(5)
    words = [f"wo{i}rd" for i in range(60)]
    rows = [(i, " ".join(rnd.choices(words[:20] if i % 3 else words[15:], k=rnd.randint(8, 40)))) for i in range(90)]
    label = {i: int(i % 3 == 0) for i, _ in rows if i % 7}
    model = toxicity.fit(frame(spark, rows), spark.createDataFrame(list(label.items()), "doc_id long, toxic int"), hold_out=False)
    units = {i: {u for w in t.encode().split() for u in toxicity.unit_hashes(w)} for i, t in rows}
    fold = {i: (lambda h: (h - (1 << 64) if h >> 63 else h) % toxicity.FOLDS)(xxhash.xxh64_intdigest(t.encode(), 42)) for i, t in rows}
    total = sum(map(len, units.values()))

    def learnt(left_out):
        own = [i for i in label if fold[i] != left_out]
        n = [sum(len(units[i]) for i in own if label[i] == y) for y in (0, 1)]
        weight, out = toxicity.PRIOR_SHARE * sum(n), {}
        for u in set().union(*(units[i] for i in label)):
            a = sum(u in x for x in units.values()) * weight / total
            c = [sum(u in units[i] for i in own if label[i] == y) for y in (0, 1)]
            odds = [np.log((c[y] + a) / (n[y] + weight - c[y] - a)) for y in (0, 1)]
            z = (odds[1] - odds[0]) / np.sqrt(1 / (c[0] + a) + 1 / (c[1] + a))
            if abs(z) >= toxicity.LEAST_Z:
                out[u] = (odds[1] - odds[0], z)
        return out

    def of(text, scores):
        best = [max((scores[u] for u in toxicity.unit_hashes(w) if u in scores), key=lambda x: abs(x[1]), default=(toxicity.DRIFT, 0))[0] for w in text.encode().split()]
        return np.array(best)

    whole, folds = learnt(None), [learnt(f) for f in range(toxicity.FOLDS)]
    assert {int(u): (round(d, 9), round(z, 9)) for u, d, z in zip(model.scores.units, model.scores.odds, model.scores.z, strict=True)} == {u: (round(d, 9), round(z, 9)) for u, (d, z) in whole.items()}
    own = {i: of(t, folds[fold[i]]) for i, t in rows if i in label}
    clean = [x for i, x in own.items() if not label[i]]
    seen = np.bincount(np.concatenate([(x[x > 0] / toxicity.CLASS_WIDTH).astype(int) for x in clean]), minlength=toxicity.CLASSES)
    value = np.append((np.arange(toxicity.CLASSES) + 0.5) * toxicity.CLASS_WIDTH, max(d for d, _ in whole.values()))
    n = sum(map(len, clean)) + 1
    moment = lambda x: (np.append(seen, 1) * np.exp(x * value)).sum() / n + (1 - (seen.sum() + 1) / n) * np.exp(x * toxicity.DRIFT)
    assert abs(moment(model.lam) - 1) < 1e-6 or model.lam == 1e-3
    best = [max((s for _, _, s in toxicity.maximal_segments(x)), default=0.0) for x in clean]
    assert np.isclose(model.k, (len(clean) + 1) / (sum(len(x) * np.exp(-model.lam * b) for x, b in zip(clean, best, strict=True)) + 1))
    ln_e = lambda x: sum(max(0.0, model.lam * sum(x[a:b]) - np.log(model.k * len(x))) for a, b in brute(x.tolist()))
    got = {r.doc_id: r.score for r in toxicity.toxicity_scores(frame(spark, rows), model).collect()}
    for i, t in rows[:25]:
        assert np.isclose(got[i], 1 / (1 + np.exp(-(model.intercept + model.slope * np.sqrt(ln_e(of(t, whole)))))), atol=1e-6)


def test_rows_are_judged_by_their_own_text(spark):
    words = [f"w{i}" for i in range(100)]
    rnd = random.Random(4)
    rows = [(i, " ".join(rnd.choices(words, k=40)) + (" you nasty nasty fool nasty fool" if i % 4 == 0 else "")) for i in range(120)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int")
    more = [(1, rows[0][1]), (0, rows[1][1]), (None, rows[4][1]), (None, None), (500, "")]
    docs = frame(spark, rows + more)
    got = toxicity.without_toxic(docs, labels)
    assert got.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in got.collect()]
    assert sorted(kept, key=str) == sorted([(i, t) for i, t in rows + more if "nasty" not in (t or "")], key=str)
