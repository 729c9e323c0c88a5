"""Toxic passages: maximum-scoring segments of token log-odds, with extreme-value significance.

A word's score is the log-odds of one of its units (the word or a beginning of it)
between toxic and clean documents under an informative Dirichlet prior (Monroe, Colaresi
and Quinn, 2008) whose weights are the token's counts over the whole corpus; tokens that don't stand out score a small
negative amount. A linear-time scan (Ruzzo and Tompa, 1999) finds every maximal segment of a text. Scores of chance
segments follow an extreme-value law with E = K m exp(-lambda S) for a text of m tokens (Karlin and Altschul, 1990):
lambda is the root of the background's moment equation, K is fitted on clean documents. A document's evidence is the
sum of -ln E over its segments with E below 1; a logistic curve turns it into a score.

Units are counted by their full 64-bit hashes, as many as the corpus has, in a Spark aggregate. The driver and the executors
get only those of labelled documents that stand out, whose number MAX_LABELLED bounds. Labelled texts are dealt to FOLDS by their
hashes; lambda, K and the curve are fitted on each fold with the scores learnt from the others.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import Memory, arrow_task, clean_texts, dropped, give_back, kept_objects, slice_words, slices, staged, word_lengths_to_starts

#: Units a counting task holds before it hands on their counts.
HELD_UNITS = 1 << 19
#: Words that each half of a task's memory keeps (some 8 MB).
KEPT_WORDS = 40_000
#: Labelled documents used for fitting at most: those with the smallest hashes of their ids.
MAX_LABELLED = 40_000
#: Parts of the labelled documents, each scored with what the others teach.
FOLDS = 4
#: Weight of the prior as a share of the labelled documents, the deviations a token must stand out by, the score of other tokens.
PRIOR_SHARE, LEAST_Z, DRIFT = 0.1, 3.5, -0.15
#: Lengths of the word beginnings that count as units.
PREFIXES = (4, 5, 6, 7)
#: Width and number of the classes in which background scores are counted.
CLASS_WIDTH, CLASSES = 0.05, 400
#: Segments with a chance of this or less are significant.
LEAST_P = 0.01


#: ASCII characters other than letters and digits: what is dropped around a plain word.
_AROUND = bytes(c for c in range(128) if not chr(c).isalnum())


def unit_hashes(word: bytes) -> list[int]:
    """64-bit hashes of a word's units.

    Units are the word's letters and digits in lower case, without punctuation around it, and its beginnings: a word that
    was never labelled is known by the family it belongs to.
    """
    digest = xxhash.xxh64_intdigest
    if word.isascii():
        core = word.lower().strip(_AROUND)
        units = [digest(b"^" + core[:n]) for n in PREFIXES if n < len(core)]
        return [digest(core), *units] if core else units
    text = word.decode("utf-8", "replace").lower()
    a, b = 0, len(text)
    while a < b and not text[a].isalnum():
        a += 1
    while b > a and not text[b - 1].isalnum():
        b -= 1
    text = text[a:b]
    return [digest(u.encode()) for u in ([text] if text else []) + [f"^{text[:n]}" for n in PREFIXES if n < len(text)]]


class Units:
    """The units of words; those of words that are frequent at present are kept."""

    def __init__(self):
        self.kept = Memory(KEPT_WORDS)

    def of(self, words: list[bytes], times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The units of distinct words, one word after the other, and where each word's start, with the end."""
        found = self.kept.all(words)
        for i in [i for i, x in enumerate(found) if x is None]:
            found[i] = array("Q", unit_hashes(words[i])).tobytes()
            if times[i] > 1:
                self.kept.put(words[i], found[i])
        return np.frombuffer(b"".join(found), np.uint64), word_lengths_to_starts(np.fromiter(map(len, found), np.int64, len(found)) // 8)


@dataclass(frozen=True)
class UnitScores:
    """Units in ascending order, their log-odds and the deviations they stand out by."""

    units: np.ndarray
    odds: np.ndarray
    z: np.ndarray

    def of(self, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Score of each word, given its units: the log-odds of the one that stands out most, the first of equal ones; DRIFT if none does."""
        n = len(starts) - 1
        if not len(self.units) or not n:
            return np.full(n, DRIFT)
        at = np.minimum(np.searchsorted(self.units, flat), len(self.units) - 1)
        known = self.units[at] == flat
        row = np.repeat(np.arange(n), np.diff(starts))
        z, odds = np.zeros((2, n, 1 + len(PREFIXES)))
        column = np.arange(len(flat)) - starts[row]
        z[row, column], odds[row, column] = np.where(known, np.abs(self.z[at]), 0), self.odds[at]
        best = z.argmax(axis=1)
        there = np.arange(n)
        return np.where(z[there, best] > 0, odds[there, best], DRIFT)


def _scored_texts(texts: pa.Array, units: Units, scores: list[UnitScores], fold: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """(row, scores of its words) for each text, with the scores that belong to its fold."""
    for i, j in slices(texts):
        words, codes, starts = slice_words(texts.slice(i, j - i))
        own = units.of(words, np.bincount(codes, minlength=len(words)))
        by_word = [s.of(*own) for s in scores]
        for k in range(j - i):
            yield i + k, by_word[0 if fold is None else fold[i + k]][codes[starts[k] : starts[k + 1]]]


def _slice_counts(texts: pa.Array, kind: np.ndarray, units_of: Units) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit, kind, documents): how many documents hold each unit; kind 0 counts all documents, others those of that kind."""
    words, codes, starts = slice_words(texts)
    flat, first = units_of.of(words, np.bincount(codes, minlength=len(words)))
    units, local = np.unique(flat, return_inverse=True)
    if not len(units):
        return units, np.zeros(0, np.int64), np.zeros(0, np.int64)
    doc, word = np.divmod(np.unique(np.repeat(np.arange(len(texts)), np.diff(starts)) * len(words) + codes), len(words))
    n = np.diff(first)[word]
    at = np.arange(n.sum()) + np.repeat(first[word] - (np.cumsum(n) - n), n)
    doc, unit = np.divmod(np.unique(np.repeat(doc, n) * len(units) + local[at]), len(units))
    both, k = np.concatenate([unit, unit]), np.concatenate([np.zeros(len(unit), np.int64), kind[doc]])
    again = np.concatenate([np.ones(len(unit), bool), kind[doc] > 0])
    key, docs = np.unique(k[again] * len(units) + both[again], return_counts=True)
    return units[key % len(units)], key // len(units), docs


def _document_counts(batches):
    """(text, kind) to (unit, kind, docs): partial counts; kind is 0 for rows without a label."""
    held: list[tuple] = []
    units_of = Units()

    def merged() -> pa.RecordBatch:
        unit, kind, docs = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((kind, unit))
        unit, kind, docs = unit[order], kind[order], docs[order]
        first = np.flatnonzero(np.concatenate([[True], (unit[1:] != unit[:-1]) | (kind[1:] != kind[:-1])])) if len(unit) else np.zeros(0, np.int64)
        docs = np.add.reduceat(docs, first) if len(unit) else docs
        return pa.RecordBatch.from_arrays([pa.array(unit[first].view(np.int64)), pa.array(kind[first].astype(np.int32)), pa.array(docs)], names=["unit", "kind", "docs"])

    for batch in batches:
        texts, kind = clean_texts(batch.column("__text")), batch.column("kind").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for i, j in slices(texts):
            held.append(_slice_counts(texts.slice(i, j - i), kind[i:j], units_of))
            if sum(len(x[0]) for x in held) >= HELD_UNITS:
                yield merged()
                held.clear()
    if held:
        yield merged()


@dataclass(frozen=True)
class ToxicityModel:
    scores: UnitScores
    lam: float
    k: float
    intercept: float
    slope: float


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, end, score), left to right, in linear time.

    Of equal segments all are found; one that a stretch with the sum zero could lengthen keeps its shorter form."""
    total = np.concatenate([[0.0], np.cumsum(scores, dtype=np.float64)])
    stack: list[list] = []  # first, end, sum before, sum at the end, nearest earlier entry with a smaller sum before
    for i in np.flatnonzero(scores > 0).tolist():
        first, before, after = i, total[i], total[i + 1]
        j = len(stack) - 1
        while True:
            while j >= 0 and stack[j][2] >= before:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= after:
                stack.append([first, i + 1, before, after, j])
                break
            first, before, up = stack[j][0], stack[j][2], stack[j][4]
            del stack[j:]
            j = up
    return [(a, b, after - before) for a, b, before, after, _ in stack]


def evidence(own: np.ndarray, lam: float, k: float) -> tuple[float, list[tuple[int, int, float, float]]]:
    """Of a text's word scores: summed -ln E of the segments with E below 1, and the significant ones (first word, words, score, chance)."""
    if not (own > 0).any():
        return 0.0, []
    out, total = [], 0.0
    for a, b, s in maximal_segments(own):
        e = k * len(own) * math.exp(-lam * s)
        p = -math.expm1(-e)
        total += max(0.0, -math.log(max(e, 1e-300)))
        if p <= LEAST_P:
            out.append((a, b - a, s, p))
    return total, out


def _held_out(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % 5 == 0


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Intercept and slope by Newton steps with a small ridge."""
    w = np.zeros(2)
    design = np.stack([np.ones_like(x), x], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + 1e-2 * np.eye(2), design.T @ (y - p) - 1e-2 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", hold_out: bool = True) -> ToxicityModel:
    """Fit on at most MAX_LABELLED labelled documents; the prior counts every document of ``docs``.

    Rows that share an id share its label; a label other than 0 is toxic.
    Ids without a label, null labels and ids labelled both ways are left out; with ``hold_out``, so are ids whose crc32 is
    divisible by 5. Copies of a labelled text count once. Without any labelled document, nothing is toxic.
    """
    spark = docs.sparkSession
    known = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("label")).where("__id is not null and label is not null")
    if hold_out:
        known = known.where(~_held_out(F.col("__id")))
    known = known.groupBy("__id").agg(F.min("label").alias("label"), F.max("label").alias("__other")).where("label = __other").select("__id", "label")
    known = staged(known.orderBy(F.xxhash64("__id"), "__id").limit(MAX_LABELLED), "labelled")
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    texts = rows.join(F.broadcast(known), "__id")  # MAX_LABELLED rows at most
    # Of equal texts the smallest id counts, in the fold of their hash.
    once = texts.groupBy(F.xxhash64("__text").alias("__th")).agg(F.min("__id").alias("__id")).groupBy("__id").agg(F.min(F.pmod("__th", F.lit(FOLDS))).cast("int").alias("fold"))
    once = staged(once.join(F.broadcast(known), "__id"), "fitted")
    kind = 1 + 2 * F.col("fold") + F.col("label").cast("boolean").cast("int")
    marked = rows.join(F.broadcast(once), "__id", "left").select("__text", kind.cast("int").alias("kind"))
    of = lambda k: F.sum(F.when(F.col("kind") == k, F.col("docs")))
    counts = marked.mapInArrow(arrow_task(_document_counts), "unit long, kind int, docs long").groupBy("unit")
    counts = staged(counts.agg(of(0).alias("docs"), *(of(1 + 2 * f + y).alias(f"y{y}_{f}") for f in range(FOLDS) for y in (0, 1))), "counts")
    seen = lambda y, left_out: sum((F.coalesce(f"y{y}_{f}", F.lit(0)) for f in range(FOLDS) if f != left_out), F.lit(0))
    models = [None, *range(FOLDS)]  # with all folds, and without each
    totals = counts.agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("docs"), *(F.coalesce(F.sum(seen(y, m)), F.lit(0)).alias(f"n{y}_{m}") for m in models for y in (0, 1))).first()
    if not totals["n0_None"] or not totals["n1_None"]:
        dropped(known, once, counts)
        return ToxicityModel(UnitScores(*np.zeros((3, 0))), 1.0, 1.0, -20.0, 1.0)
    columns = {}
    for m in models:
        n = [float(totals[f"n{y}_{m}"]) for y in (0, 1)]
        weight = PRIOR_SHARE * sum(n)
        a = F.col("docs") * (weight / totals["docs"])
        odds = [F.log((seen(y, m) + a) / (n[y] + weight - seen(y, m) - a)) for y in (0, 1)]
        columns[f"d_{m}"] = odds[1] - odds[0]
        columns[f"z_{m}"] = columns[f"d_{m}"] / F.sqrt(1 / (seen(1, m) + a) + 1 / (seen(0, m) + a))
    stands_out = F.greatest(*(F.coalesce(F.abs(F.nanvl(f"z_{m}", F.lit(0.0))), F.lit(0.0)) for m in models)) >= LEAST_Z
    # Units of MAX_LABELLED documents at most
    kept = counts.where(seen(0, None) + seen(1, None) > 0).select("unit", *(c.alias(name) for name, c in columns.items())).where(stands_out).toPandas()
    unit = kept["unit"].to_numpy(np.int64).view(np.uint64)

    def scores_of(m) -> UnitScores:
        d, z = kept[f"d_{m}"].to_numpy(float), kept[f"z_{m}"].to_numpy(float)
        own = np.flatnonzero(np.nan_to_num(np.abs(z)) >= LEAST_Z)
        own = own[np.argsort(unit[own])]
        return UnitScores(unit[own], d[own], z[own])

    scores = scores_of(None)
    folds = spark.sparkContext.broadcast([scores_of(m) for m in range(FOLDS)])  # units of MAX_LABELLED documents at most

    def profile(batches):
        """Per clean fitted document: tokens, best segment; with a batch's first row, its tokens by class of score."""
        units = Units()
        for batch in batches:
            tokens, best, classes = [], [], np.zeros(CLASSES, np.int64)
            for _, own in _scored_texts(clean_texts(batch.column("__text")), units, folds.value, batch.column("fold").to_numpy()):
                tokens.append(len(own))
                best.append(max((s for _, _, s in maximal_segments(own)), default=0.0))
                classes += np.bincount(np.minimum(own[own > 0] / CLASS_WIDTH, CLASSES - 1).astype(np.int64), minlength=CLASSES)
            lists = pa.array([classes.tolist() if i == 0 else None for i in range(len(tokens))], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.int64()), pa.array(best, pa.float64()), lists], names=["tokens", "best", "classes"])

    fitted = rows.join(F.broadcast(once), "__id")
    # MAX_LABELLED rows at most
    clean = fitted.where("label = 0").select("__text", "fold").mapInArrow(arrow_task(profile), "tokens long, best double, classes array<long>").toPandas()
    seen_classes = np.sum([np.array(x) for x in clean["classes"] if x is not None] or [np.zeros(CLASSES)], axis=0)
    lam = _root(seen_classes, max(1.0, float(clean["tokens"].sum())), float(max(scores.odds, default=1.0)))
    best, tokens = clean["best"].to_numpy(), clean["tokens"].to_numpy()
    # Maximum likelihood of K under P(S <= s) = exp(-K m exp(-lambda s)).
    k = (len(best) + 1) / (float((tokens * np.exp(-lam * best)).sum()) + 1)

    def weigh(batches):
        units = Units()
        for batch in batches:
            x = [evidence(own, lam, k)[0] for _, own in _scored_texts(clean_texts(batch.column("__text")), units, folds.value, batch.column("fold").to_numpy())]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(x, pa.float64())], names=["label", "x"])

    points = fitted.select("__text", "fold", "label").mapInArrow(arrow_task(weigh), "label int, x double").toPandas()  # MAX_LABELLED rows at most
    folds.destroy()
    dropped(known, once, counts)
    intercept, slope = _logistic(np.sqrt(np.maximum(points["x"].to_numpy(), 0)), (points["label"] != 0).to_numpy(float))
    return ToxicityModel(scores, lam, k, intercept, max(slope, 1e-3))


def _root(seen: np.ndarray, total: float, top: float) -> float:
    """lambda > 0 at which exp(lambda * score) of a background token has the mean 1; the largest score counts once more."""
    value = (np.arange(CLASSES) + 0.5) * CLASS_WIDTH
    value, share = np.append(value, top), np.append(seen, 1.0) / (total + 1)
    rest = 1 - share.sum()
    moment = lambda x: float((share * np.exp(np.minimum(x * value, 600))).sum()) + rest * math.exp(x * DRIFT) - 1
    low, high = 1e-6, 1.0
    while moment(high) < 0 and high < 64:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if moment(mid) < 0 else (low, mid)
    return max(high, 1e-3)


def _scoring(model: ToxicityModel) -> Callable:
    """A Spark function of a text column: the score from 0 to 1."""

    @F.arrow_udf("double")
    def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kept_objects.clear()
        units = Units()
        for column in columns:
            x = [evidence(own, model.lam, model.k)[0] for _, own in _scored_texts(clean_texts(column), units, [model.scores])]
            yield pa.array(1 / (1 + np.exp(-np.clip(model.intercept + model.slope * np.sqrt(np.maximum(x, 0.0)), -700, 700))), pa.float64())

    return score


def toxicity_scores(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id_col, score, predicted``; only the text is an input. Null and empty texts have no evidence, repeated rows
    and null ids have rows of their own."""
    scored = docs.select(F.col(id_col), _scoring(model)(F.col(text_col).cast("string")).alias("score"))
    return scored.select(id_col, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxic_passages(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every significant passage: ``id_col, first_word, n_words, passage_score, chance``. Null and empty texts have none;
    repeated rows give theirs again."""

    def passages(batches):
        units = Units()
        for batch in batches:
            found = [evidence(own, model.lam, model.k)[1] for _, own in _scored_texts(clean_texts(batch.column("__text")), units, [model.scores])]
            at = pa.array([i for i, f in enumerate(found) for _ in f], pa.int64())
            flat = [s for f in found for s in f]
            columns = [pa.array([s[c] for s in flat], kind) for c, kind in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([batch.column("__id").take(at), *columns], names=["__id", "first_word", "n_words", "passage_score", "chance"])

    source = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    kind = source.schema["__id"].dataType.simpleString()
    return source.mapInArrow(arrow_task(passages), f"__id {kind}, first_word long, n_words long, passage_score double, chance double").withColumnRenamed("__id", id_col)


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fit without the held-out fifth, then per row: ``id_col, held_out, score, predicted``."""
    model = fit(docs, labels, id_col, text_col)
    give_back()  # the driver's tables of the fit
    out = toxicity_scores(docs, model, id_col, text_col)
    return out.select(id_col, F.coalesce(_held_out(F.col(id_col)), F.lit(False)).alias("held_out"), "score", "predicted")


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that score below the threshold; all labels are used for fitting.

    Each row is judged by its own text where it stands: nothing is joined back."""
    model = fit(docs, labels, id_col, text_col, hold_out=False)
    give_back()  # the driver's tables of the fit
    judged = docs.select(F.struct("*").alias("row"), _scoring(model)(F.col(text_col).cast("string")).alias("score"))
    return judged.where(F.col("score") < threshold).select("row.*")
