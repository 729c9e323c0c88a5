"""Joins of similar names without looking at all pairs: cosine of n-gram weights over an inverted index, and the token-sort ratio.

Both work on distinct names: copies of a name are neither compared with each other nor again with the same others."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.names import grams, sorted_tokens, subsequence_ratio

Stage = Callable[[DataFrame, str], DataFrame]
#: Allowance for sums of floating point numbers, digits a similarity is rounded to, and by how much sums may differ that round alike.
SLACK, DIGITS, NEAR = 1e-9, 9, 2e-9
#: Names to a block at most, and to one that is still cut so that all cores have work.
BLOCK, LEAST_BLOCK = 250_000, 2_000
#: In a block: targets met before the best are summed in full for the first time (then as often as they double), and targets that are summed in full at once.
SEED, FEW = 200, 50
#: Subsequences of a name that are joined at most; where there are more, pairs of rare characters are.
MOST_SUBSEQUENCES = 300


def _first(rows: DataFrame, keys: list[str], order: list[Column], most: int, rank: str = "rank") -> DataFrame:
    return rows.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= most)


def gram_weights(a: DataFrame, b: DataFrame, name: str, n: int, stage: Stage) -> DataFrame:
    """The stored inverted index ``name, in_a, in_b, g, w, left, rarity, shared``: weights of the n-grams of each distinct name.

    Weights are occurrences times ln((1 + rows) / (1 + rows with the gram)) + 1 over all rows of both sides, of unit length for a
    name. Grams of a name stand in one order for all names, the rarest first; ``left`` is the length of the vector from this gram on. ``rarity`` is the
    logarithm above, ``shared`` says whether names of both sides have the gram."""
    side = lambda rows, in_a: rows.select(F.col(name).alias("name"), F.lit(in_a).alias("is_a"))
    names = side(a, True).unionByName(side(b, False)).where("name is not null")
    names = stage(names.groupBy("name").agg(F.count(F.lit(1)).alias("rows"), F.max("is_a").alias("in_a"), F.max(~F.col("is_a")).alias("in_b")), "names")
    total = names.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    counts = names.select("name", "rows", "in_a", "in_b", F.explode(grams(F.col("name"), n)).alias("g")).groupBy("name", "rows", "in_a", "in_b", "g").agg(F.count(F.lit(1)).alias("tf"))
    counts = stage(counts, "gram-counts")
    known = counts.groupBy("g").agg(F.sum("rows").alias("df"), (F.max("in_a") & F.max("in_b")).alias("shared"))
    weighted = counts.join(known, "g").withColumn("rarity", F.log((1 + total) / (1 + F.col("df")))).withColumn("w", F.col("tf") * (F.col("rarity") + 1))
    own = Window.partitionBy("name")
    unit = weighted.withColumn("w", F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(own)))
    before = F.coalesce(F.sum(F.col("w") * F.col("w")).over(own.orderBy("df", "g").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    return stage(unit.withColumn("left", F.sqrt(F.greatest(1 - before, F.lit(0.0)))).select("name", "in_a", "in_b", "g", "w", "left", "rarity", "shared"), "gram-weights")


def similar_pairs(weights: DataFrame, floor: float) -> DataFrame:
    """``name_a, name_b, score``: pairs of distinct names with a cosine of ``floor`` or more.

    Of the grams that two names share the rarest comes first in both. If it stands where less than ``floor`` of a name's length is
    left, the pair can't reach the floor: only the grams before are joined. A pair goes on if that gram's product and what both have
    left after it allow the floor, and only such pairs are summed."""
    reach = weights.where(F.col("left") >= floor - SLACK).withColumn("after", F.sqrt(F.greatest(F.col("left") ** 2 - F.col("w") ** 2, F.lit(0.0))))
    side = lambda s: reach.where(f"in_{s}").select("g", F.col("name").alias(f"name_{s}"), F.col("w").alias(f"w_{s}"), F.col("after").alias(f"after_{s}"))
    bound = F.col("w_a") * F.col("w_b") + F.col("after_a") * F.col("after_b")
    pairs = side("a").join(side("b"), "g").where(bound >= floor - SLACK).select("name_a", "name_b").distinct()
    return _cosines(_summed(pairs, weights.groupBy("name").agg(_vector())), floor)


def _vector() -> Column:
    return F.map_from_entries(F.collect_list(F.struct("g", "w"))).alias("v")  # as long as a name


def _summed(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """``name_a, name_b, dot`` of pairs of names; ``vectors`` has ``name, v``."""
    both = pairs.join(vectors.select(F.col("name").alias("name_a"), F.col("v").alias("va")), "name_a").join(vectors.select(F.col("name").alias("name_b"), F.col("v").alias("vb")), "name_b")
    dot = F.aggregate(F.map_entries("va"), F.lit(0.0), lambda s, x: s + x["value"] * F.coalesce(F.try_element_at("vb", x["key"]), F.lit(0.0)))
    return both.select("name_a", "name_b", dot.alias("dot"))


def _cosines(pairs: DataFrame, floor: float) -> DataFrame:
    """The summed pairs that reach ``floor``, their ``dot`` rounded to ``score``."""
    return pairs.withColumn("score", F.round("dot", DIGITS)).drop("dot").where(F.col("score") >= floor)


@dataclass(frozen=True)
class NameIndex:
    """The stored distinct names of two sides, ``name, in_a, in_b, first_a, first_b`` (the smallest ids), and their stored n-grams, ``g, idf, shared``."""

    names: DataFrame
    grams: DataFrame
    n: int


def name_index(a: DataFrame, b: DataFrame, id_col: str, name: str, n: int, stage: Stage) -> NameIndex:
    """Names and n-grams, ``idf`` as in ``gram_weights``. What is stored grows with the names, not with their grams."""
    side = lambda rows, s: rows.select(F.col(name).alias("name"), F.lit(s).alias("s"), F.col(id_col).alias("id")).where("name is not null")
    on = lambda s: F.col("s") == s
    names = side(a, "a").unionByName(side(b, "b")).groupBy("name").agg(F.count(F.lit(1)).alias("rows"), *(F.max(on(s)).alias(f"in_{s}") for s in "ab"), *(F.min(F.when(on(s), F.col("id"))).alias(f"first_{s}") for s in "ab"))
    names = stage(names, "names")
    total = names.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    known = names.select("rows", "in_a", "in_b", F.explode(F.array_distinct(grams(F.col("name"), n))).alias("g")).groupBy("g").agg(F.sum("rows").alias("df"), (F.max("in_a") & F.max("in_b")).alias("shared"))
    return NameIndex(names, stage(known.select("g", (F.log((1 + total) / (1 + F.col("df"))) + 1).alias("idf"), "shared"), "grams"), n)


def name_vectors(names: DataFrame, index: NameIndex) -> DataFrame:
    """``name, first, g, w``: of ``names`` (``name, first``) the n-grams that both sides have, in order, and their weights, of unit length with all the name's others."""
    # Spread by name before they are cut into grams: where the table of grams is small, no row of a gram is shuffled.
    cut = names.repartition("name").select("name", "first", F.explode(grams(F.col("name"), index.n)).alias("g"))
    counts = cut.groupBy("name", "first", "g").agg(F.count(F.lit(1)).alias("tf")).join(index.grams, "g").withColumn("w", F.col("tf") * F.col("idf"))
    own = counts.groupBy("name", "first").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"), F.sort_array(F.collect_list(F.when(F.col("shared"), F.struct("g", "w")))).alias("e"))
    return own.where(F.size("e") > 0).select("name", "first", F.col("e.g").alias("g"), F.transform("e", lambda x: x["w"] / F.col("length")).alias("w"))


def _cut(queries: int, targets: int, cells: int) -> tuple[int, int]:
    """Blocks of queries and of targets: none of over BLOCK names, and ``cells`` pairs of blocks unless they would be small."""
    names = queries, targets
    blocks = [max(1, -(-x // BLOCK)) for x in names]
    while math.prod(blocks) < cells and max(n / k for n, k in zip(names, blocks, strict=True)) > LEAST_BLOCK:
        blocks[names[0] / blocks[0] < names[1] / blocks[1]] += 1
    return blocks[0], blocks[1]


def _sparse(grams: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The grams of all rows, and where each row's begin."""
    lists = grams.combine_chunks()
    return lists.flatten(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)])


def _row_dots(rows: np.ndarray, at: np.ndarray, grams: np.ndarray, weights: np.ndarray, query: np.ndarray) -> np.ndarray:
    """The dot products of rows, none of them empty, with a query that has a weight for every gram."""
    long = at[rows + 1] - at[rows]
    begins = np.cumsum(long) - long
    cells = np.repeat(at[rows] - begins, long) + np.arange(long.sum())
    return np.add.reduceat(query[grams[cells]] * weights[cells], begins)


def _nth(values: np.ndarray, n: int, least: float) -> float:
    """The n-th largest of values over ``least``, or that where there are fewer."""
    high = values[values > least]
    return float(np.partition(high, len(high) - n)[len(high) - n]) if len(high) >= n else least


def block_nearest(floor: float, keep: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """A task that finds of each query (``name, g, w``) the ``keep`` targets (``first``, too) of the largest cosine, ``floor`` or more.

    A query's grams are taken in order of how many targets have them, the fewest first, until targets that have none of them can't be
    among the ``keep`` best: the grams left add too little. Of those met only the ones that the grams left can lift that far go on, and
    the few that remain are summed in full. Every bound holds for the exact sums, so that nothing is lost."""

    def task(queries: pa.Table, targets: pa.Table) -> pa.Table:
        targets = targets.take(pc.sort_indices(targets["first"]))  # ties go to the smaller place
        (q_grams, q_at), (t_grams, t_at) = _sparse(queries["g"]), _sparse(targets["g"])
        code = pa.concat_arrays([q_grams, t_grams]).dictionary_encode()
        size, code = len(code.dictionary), code.indices.to_numpy()
        # Grams are numbered by how many targets have them; every row's stand in that order.
        many = np.bincount(code[len(q_grams) :], minlength=size)
        turn = np.argsort(many, kind="stable")
        number = np.empty(size, np.int32)
        number[turn] = np.arange(size, dtype=np.int32)
        code, many = number[code], many[turn]
        q_w, t_w = (x["w"].combine_chunks().flatten().to_numpy(zero_copy_only=False) for x in (queries, targets))
        q_row, t_row = (np.repeat(np.arange(len(at) - 1, dtype=np.int32), np.diff(at)) for at in (q_at, t_at))
        q_code, t_code = code[: len(q_grams)], code[len(q_grams) :]
        turn = np.lexsort((q_code, q_row))
        q_code, q_w = q_code[turn], q_w[turn]
        turn = np.lexsort((t_code, t_row))
        t_code, t_w = t_code[turn], t_w[turn]
        # The targets of each gram, its largest weight, and the greatest length of a target in the grams from each on.
        turn = np.argsort(t_code, kind="stable")
        owner, weight, begin = t_row[turn], t_w[turn], np.concatenate([[0], np.cumsum(many)])
        heaviest, longest = np.zeros(size), np.zeros(size)
        np.maximum.at(heaviest, t_code, t_w)
        sums = np.concatenate([[0.0], np.cumsum(t_w * t_w)])
        np.maximum.at(longest, t_code, sums[t_at[1:]][t_row] - sums[:-1])
        longest = np.sqrt(np.maximum.accumulate(longest[::-1])[::-1] + SLACK)
        part, whole, found = np.zeros(len(targets)), np.zeros(size), []
        for i in range(len(queries)):
            g, w = q_code[q_at[i] : q_at[i + 1]], q_w[q_at[i] : q_at[i + 1]]
            # What the grams from each on can add.
            rest = np.minimum(np.cumsum((w * heaviest[g])[::-1])[::-1], np.sqrt(np.cumsum((w * w)[::-1])[::-1]) * longest[g]).tolist() + [0.0]
            whole[g] = w
            least, k, met, n_met, tried = floor, 0, [], 0, 0
            while k < len(g) and rest[k] >= least - NEAR:
                at = slice(begin[g[k]], begin[g[k] + 1])
                p = owner[at]
                s = part[p] + w[k] * weight[at]
                part[p] = s
                met.append(p)
                n_met += len(p)
                k += 1
                least = _nth(s, keep, least)
                if n_met > max(SEED, 2 * tried) and len(p) >= keep:
                    # The best so far, summed in full, show early how much is needed.
                    tried = n_met
                    lead = p[np.argpartition(s, len(s) - keep)[len(s) - keep :]]
                    least = max(least, float(_row_dots(lead, t_at, t_code, t_w, whole).min()))
            if met:
                met = np.concatenate(met)
                near = np.sort(met[part[met] >= least - NEAR - rest[k]])
                near = near[np.concatenate([[True], near[1:] != near[:-1]])] if len(near) else near
                while k < len(g) and len(near) > FEW:
                    at = slice(begin[g[k]], begin[g[k] + 1])
                    p = owner[at]
                    place = np.minimum(np.searchsorted(p, near), len(p) - 1)
                    s = part[near] + np.where(p[place] == near, w[k] * weight[at][place], 0.0)
                    part[near] = s
                    k += 1
                    least = _nth(s, keep, least)
                    near = near[s >= least - NEAR - rest[k]]
                part[met] = 0.0
                dots = _row_dots(near, t_at, t_code, t_w, whole) if len(near) else np.zeros(0)
                score = np.round(dots, DIGITS)
                best = np.lexsort((near, -score))[:keep]
                best = best[score[best] >= floor]
                found.append((np.full(len(best), i), near[best], dots[best]))
            whole[g] = 0.0
        a, b, dots = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return pa.table({"of": queries["name"].take(pa.array(a)), "name": targets["name"].take(pa.array(b)), "dot": dots})

    return task


def nearest_names(index: NameIndex, ids: DataFrame, of: str, floor: float, keep: int, only: DataFrame | None = None) -> DataFrame:
    """``name, id, score``: of each distinct name of side ``of`` (a or b) the ``keep`` most similar rows of the other side.

    Similarities are cosines of ``floor`` or more, ties go to the smaller id; ``ids`` has ``name, id`` of the other side, of each name at
    least its ``keep`` smallest ids. With ``only``, names that are in its column ``name`` are searched for, against all others.

    Blocks of names meet blocks of the other side's, each pair of them in a task that holds an index of its targets (``block_nearest``).
    No pair of names leaves a task but the ``keep`` best of a block, so that what is shuffled is the names, once for each block they meet."""
    to = "b" if of == "a" else "a"
    side = lambda s: index.names.where(f"in_{s}").select(F.col("name").alias("name"), F.col(f"first_{s}").alias("first"))
    queries, targets = side(of) if only is None else side(of).join(only.select("name"), "name", "left_semi"), side(to)
    n_q, n_t = _cut(queries.count(), targets.count(), targets.sparkSession.sparkContext.defaultParallelism)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    block = lambda n: F.pmod(F.xxhash64("name"), F.lit(n)).cast("int")
    left = name_vectors(queries, index).select("name", "g", "w", block(n_q).alias("q"), every(n_t).alias("t")).groupBy("q", "t")
    right = name_vectors(targets, index).select("name", "first", "g", "w", block(n_t).alias("t"), every(n_q).alias("q")).groupBy("q", "t")
    near = left.cogroup(right).applyInArrow(block_nearest(floor, keep), "of string, name string, dot double")
    best = _first(_cosines(near, floor).join(ids, "name"), ["of"], [F.col("score").desc(), F.col("id")], keep)
    return best.select(F.col("of").alias("name"), "id", "score")


def similar_names(a: DataFrame, b: DataFrame, stage: Stage, id_col: str = "id", name: str = "name", floor: float = 0.4, top: int = 5, n: int = 3, others_only: bool = False) -> DataFrame:
    """``id_a, id_b, score, rank``: of each row of ``a`` the ``top`` rows of ``b`` with the most similar names, ``floor`` or more, ties by id.

    Similarity is the cosine of the names' n-gram weights (``gram_weights``). With ``others_only``, a row is not matched with one of
    its own id. Names that are null or shorter than an n-gram match nothing. ``stage`` writes a frame to shared storage and reads it back."""
    keep = top + int(others_only)
    ids = stage(_first(b.select(F.col(name).alias("name"), F.col(id_col).alias("id")), ["name"], [F.col("id")], keep).drop("rank"), "name-ids")
    best = nearest_names(name_index(a, b, id_col, name, n, stage), ids, "a", floor, keep)
    found = a.select(F.col(id_col).alias("id_a"), F.col(name).alias("name")).join(best.withColumnRenamed("id", "id_b"), "name").select("id_a", "id_b", "score")
    order = [F.col("score").desc(), F.col("id_b")]
    return _first(found.where("id_a <> id_b") if others_only else found, ["id_a"], order, top)


def _signed(names: DataFrame, tokens: DataFrame, cutoff: float) -> DataFrame:
    """``name, signature``: pairs of the rarest characters of each name, so that two names whose ratio reaches ``cutoff`` share a pair.

    A ratio of c needs a common subsequence of c / 200 of both lengths, hence as many common characters (counted with repeats), and
    a partner's length is bounded by that. Without one fewer than these of its rarest characters a name can't hold enough of them.
    One more character that all names have, the commonest, makes pairs of those of short names."""
    part = cutoff / 200
    least = F.ceil(part * (F.col("l") + F.ceil(F.col("l") * part / (1 - part) - SLACK)) - SLACK)
    chars = names.select("name", F.length("name").alias("l"), F.posexplode(F.split("name", "")).alias("i", "c"))
    chars = chars.withColumn("k", F.row_number().over(Window.partitionBy("name", "c").orderBy("i"))).join(F.broadcast(tokens), ["c", "k"])
    own = chars.groupBy("name", "l").agg(F.sort_array(F.collect_list(F.struct("n", "c", "k"))).alias("rare"))  # as long as a name
    rare = F.slice(F.concat(F.transform("rare", lambda x: F.concat(x["c"], x["k"].cast("string"))), F.array(F.lit(""))), F.lit(1), (F.col("l") - least + 2).cast("int"))
    two = F.flatten(F.transform(rare, lambda x, i: F.transform(F.slice(rare, i + 2, F.size(rare)), lambda y: F.concat_ws("\n", x, y))))
    return own.select("name", F.explode(two).alias("signature"))


def _shape(letters: list[str]) -> Column:
    """A name's length and how many of its characters are among ``letters``, as text."""
    return F.concat_ws(",", F.length("name"), F.size(F.filter(F.split("name", ""), lambda c: c.isin(letters))))


def name_shapes(names_a: DataFrame, names_b: DataFrame) -> tuple[list[str], list[str], list[str]]:
    """The characters that occur on both sides and each side's distinct shapes: as many as there are characters and lengths, not names."""
    chars = lambda rows: rows.select(F.explode(F.split("name", "")).alias("c")).distinct()
    letters = sorted(r[0] for r in chars(names_a).intersect(chars(names_b)).collect())
    return letters, *([r[0] for r in rows.select(_shape(letters)).distinct().collect()] for rows in (names_a, names_b))


def _least(a: str, b: str, cutoff: float) -> tuple[int, int, int]:
    """Of two shapes: the common characters that ``cutoff`` needs, and how many both have to choose from."""
    (long_a, own_a), (long_b, own_b) = (map(int, x.split(",")) for x in (a, b))
    return math.ceil(cutoff / 200 * (long_a + long_b) - SLACK), own_a, own_b


def _subsequences(needs: dict[str, set[int]], letters: list[str]) -> Callable:
    def run(frames):
        known = set(letters)
        for f in frames:
            own = ((name, [c for c in name if c in known], shape) for name, shape in zip(f["name"], f["shape"], strict=True))
            yield pd.DataFrame([(name, "".join(x)) for name, text, shape in own for n in needs.get(shape, ()) for x in set(combinations(text, n))], columns=["name", "signature"])

    return run


def ratio_pairs(names_a: DataFrame, names_b: DataFrame, cutoff: float, shapes: tuple[list[str], list[str], list[str]] | None = None) -> DataFrame:
    """``name_a, name_b, score``: all pairs of distinct texts (column ``name``) whose subsequence ratio is ``cutoff`` or more.

    Characters that only one side has are in no common subsequence. Where few of the others may be missing, both names' subsequences of the
    length needed are joined; elsewhere pairs of rare characters."""
    letters, shapes_a, shapes_b = shapes or name_shapes(names_a, names_b)
    short, rough = ({}, {}), (set(), set())
    for x in shapes_a:
        for y in shapes_b:
            least, *own = _least(x, y, cutoff)
            if least <= min(own):
                few = max(comb(n, least) for n in own) <= MOST_SUBSEQUENCES
                for k, shape in enumerate((x, y)):
                    short[k].setdefault(shape, set()).add(least) if few else rough[k].add(shape)
    shaped = [rows.withColumn("shape", _shape(letters)) for rows in (names_a, names_b)]
    signed = lambda k: shaped[k].mapInPandas(_subsequences(short[k], letters), "name string, signature string").withColumnRenamed("name", f"name_{'ab'[k]}")
    pairs = signed(0).join(signed(1), "signature").select("name_a", "name_b")
    if rough[0]:
        both = names_a.select("name").unionByName(names_b.select("name")).distinct()
        chars = both.select("name", F.explode(F.split("name", "")).alias("c")).groupBy("name", "c").agg(F.count(F.lit(1)).alias("m"))
        # A row for each character and number of its occurrences in a name: as many as there are characters, not names.
        tokens = chars.select("c", F.explode(F.sequence(F.lit(1), F.col("m").cast("int"))).alias("k")).groupBy("c", "k").agg(F.count(F.lit(1)).alias("n"))
        side = lambda k: _signed(shaped[k].where(F.col("shape").isin(sorted(rough[k]))).select("name"), tokens, cutoff).withColumnRenamed("name", f"name_{'ab'[k]}")
        pairs = pairs.unionByName(side(0).join(side(1), "signature").select("name_a", "name_b"))
    a, b = F.length("name_a"), F.length("name_b")
    near = pairs.distinct().where(cutoff / 200 * (a + b) <= F.least(a, b) + SLACK)
    return near.withColumn("score", F.round(subsequence_ratio("name_a", "name_b"), DIGITS)).where(F.col("score") >= cutoff)


def best_names(a: DataFrame, b: DataFrame, stage: Stage, id_col: str = "id", name: str = "name", cutoff: float = 70.0, rival_floor: float = 50.0) -> DataFrame:
    """``id_a, id_b, score, runner_up``: one-to-one matches of names by the token-sort ratio, ``cutoff`` or more.

    Each row of ``a`` goes to its best row of ``b`` (ties: the smaller id); of the rows that go to one row of ``b`` the best stays (ties:
    the smaller id). ``runner_up`` is the best other claim: the second row of ``b`` for the row that stays, or a row of ``a`` that lost;
    second rows below ``rival_floor`` are null. Empty names match nothing.

    Names are searched for level by level, near ones first: a name that has two partners at a level, all of that level's, needs no lower one."""
    side = lambda rows, s: rows.select(F.col(id_col).alias(f"id_{s}"), sorted_tokens(F.col(name)).alias(f"name_{s}")).where(f"name_{s} <> ''")
    rows_a, rows_b = stage(side(a, "a"), "names-a"), stage(side(b, "b"), "names-b")
    ids = stage(_first(rows_b, ["name_b"], [F.col("id_b")], 2).drop("rank"), "name-ids")
    left, names_b, found = rows_a.select(F.col("name_a").alias("name")).distinct(), ids.select(F.col("name_b").alias("name")).distinct(), None
    order = [F.col("score").desc(), F.col("id_b")]
    shapes = name_shapes(left, names_b)
    last_level = min(cutoff, rival_floor)
    for level in sorted({float(x) for x in range(5, 100, 5) if x > last_level} | {cutoff, rival_floor}, reverse=True):
        if not any(least <= min(own) for x in shapes[1] for y in shapes[2] for least, *own in [_least(x, y, level)]):
            continue
        left = stage(left, "names-left")
        if left.isEmpty():
            break
        own = stage(_first(ratio_pairs(left, names_b, level, shapes).join(ids, "name_b"), ["name_a"], order, 2).select("name_a", "id_b", "score", "rank"), "best-names")
        full = own.where("rank = 2").select(F.col("name_a").alias("name"))
        last = level == last_level
        kept = own if last else own.join(full.withColumnRenamed("name", "name_a"), "name_a", "left_semi")
        found = kept if found is None else found.unionByName(kept)
        left = left.join(full, "name", "left_anti")
    if found is None:
        return rows_a.join(rows_b, F.lit(False)).select("id_a", "id_b", F.lit(0.0).alias("score"), F.lit(0.0).alias("runner_up"))
    edges = found.groupBy("name_a").agg(F.max(F.when(F.col("rank") == 1, F.struct("score", "id_b"))).alias("best"), F.max(F.when(F.col("rank") == 2, F.col("score"))).alias("second"))
    edges = rows_a.join(edges.where(F.col("best.score") >= cutoff), "name_a").select("id_a", F.col("best.id_b").alias("id_b"), F.col("best.score").alias("score"), "second")
    claims = _first(edges, ["id_b"], [F.col("score").desc(), F.col("id_a")], 2)
    won, lost = (F.when(F.col("rank") == k, F.struct("id_a", "score", "second")) for k in (1, 2))
    out = claims.groupBy("id_b").agg(F.max(won).alias("won"), F.max(lost).alias("lost"))
    return out.select("won.id_a", "id_b", "won.score", F.greatest("won.second", "lost.score").alias("runner_up"))
