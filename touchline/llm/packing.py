"""Best-fit packing of token pieces into sequences.

The numbers of pieces of each length form a histogram with at most ``capacity`` entries, whatever the corpus. On it
stands the configuration linear program: a variable for each multiset of lengths that fits into a sequence, as few
sequences as possible, every length covered as often as it occurs. Multiplicative weights solve it: a round covers a
small share of every length with configurations that a knapsack dynamic program over the capacity prices best, and lengths that it
covers less than others get dearer. A length that is covered has no weight any more. Each round's prices also bound the program from
below. The fractional answer is rounded: each configuration is taken a whole number of times, those that fill a sequence first; what is left
is priced and filled again as long as configurations that fill a sequence are found; the rest is packed best fit, longest first.
The plan says how many sequences each configuration fills; pieces get their place in it by
their rank among the pieces of their length, which Spark computes without bringing a length into one task.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import staged
from touchline.llm.tokens import encode_pieces

#: Columns priced in all, and the fewest and most rounds of the multiplicative weights: a round covers its part of every length.
COLUMNS, LEAST_ROUNDS, MOST_ROUNDS = 24_000, 12, 120
#: How fast prices follow the shares that rounds leave uncovered, and what a column's value may lack of the best one's.
RATE, LACK = 0.01, 0.004
#: Sequences' worth of the shortest pieces that rounding keeps for the last, to fill gaps.
RESERVE = 8
#: Rank groups of a length for each shuffle partition, and the fewest pieces for one.
GROUPS, RANK_ROWS = 4, 64

Config = tuple[tuple[int, int], ...]


def _knapsack(sizes: np.ndarray, value: np.ndarray, capacity: int) -> np.ndarray:
    """Best value for each capacity, items in any number."""
    best = np.zeros(capacity + 1)
    until = np.searchsorted(sizes, np.arange(capacity + 1), "right")
    for c in range(int(sizes[0]), capacity + 1):
        n = until[c]
        best[c] = max(best[c - 1], (best[c - sizes[:n]] + value[:n]).max())
    return best


def _column(k: int, sizes: np.ndarray, price: np.ndarray, best: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(items, how often) of a filling with item ``k``: of the items that the table of best values allows for, within LACK, the one
    with the largest share left; if none of these has any left, the one that loses least."""
    out, c = {k: 1}, len(best) - 1 - int(sizes[k])
    slack = LACK / 2 * best[-1] - (best[-1] - price[k] - best[c])
    while c >= sizes[0]:
        n = int(np.searchsorted(sizes, c, "right"))
        lost = best[c] - best[c - sizes[:n]] - price[:n]
        fitting = np.where(lost <= max(slack, 0.0) + 1e-9, share[:n], 0.0)
        i = int(fitting.argmax())
        if fitting[i] <= 1e-9:
            fitting = np.where(share[:n] > 1e-9, -lost, -np.inf)
            i = int(fitting.argmax())
            if fitting[i] == -np.inf:
                break
        slack -= lost[i]
        out[i] = out.get(i, 0) + 1
        c -= int(sizes[i])
    return np.array(list(out)), np.array(list(out.values()))


@dataclass(frozen=True)
class Covering:
    """Configurations and how many sequences each fills, those whose value came near the best, and a bound that no covering goes below."""

    x: dict[Config, float]
    good: set[Config]
    bound: float


def configuration_lp(counts: dict[int, int], capacity: int) -> Covering:
    """A fractional covering of ``counts`` by configurations: every length exactly as often as it occurs."""
    sizes = np.array(sorted(counts), np.int64)
    need = np.array([counts[s] for s in sizes.tolist()], float)
    rounds = int(np.clip(COLUMNS / len(sizes), LEAST_ROUNDS, MOST_ROUNDS))
    price, want, covered = sizes / capacity, need / rounds, np.zeros(len(sizes))
    x, good, bound = defaultdict(float), set(), 0.0
    for r in range(1, rounds + 1):
        best = _knapsack(sizes, price, capacity)
        bound = max(bound, float(need @ price) / best[-1])  # these prices, scaled so that no configuration costs more than 1
        left = want * r - covered
        for k in np.argsort(-price, kind="stable").tolist():
            while left[k] > 1e-9 * need[k]:
                i, a = _column(k, sizes, price, best, left / want)
                near = price[i] @ a >= (1 - LACK) * best[-1]
                if not near and r < rounds:
                    break  # a later round, with other prices, covers it
                step = float((left[i] / a).min())
                left[i] -= step * a
                covered[i] += step * a
                config = tuple(sorted(zip(sizes[i].tolist(), a.tolist(), strict=True)))
                x[config] += step
                if near:
                    good.add(config)
        behind = np.minimum(left / want, 4.0)
        price = price * np.exp(RATE * (behind - behind.mean()))
    return Covering(dict(x), good, bound)


def _exact_column(k: int, sizes: np.ndarray, best: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """(items, how often) of what fills a sequence without a gap, item ``k`` and the longest others first; None if pieces lack."""
    out, c = {k: 1}, len(best) - 1 - int(sizes[k])
    while c > 0:
        n = int(np.searchsorted(sizes, c, "right"))
        fitting = (best[c - sizes[:n]] + sizes[:n] == c) & (left[:n] > 0)
        for i, a in out.items():
            if i < n and left[i] <= a:
                fitting[i] = False
        good = np.flatnonzero(fitting)
        if not len(good):
            return None
        i = int(good[-1])
        out[i] = out.get(i, 0) + 1
        c -= int(sizes[i])
    return np.array(list(out)), np.array(list(out.values()))


def _rounded(covering: Covering, counts: dict[int, int], capacity: int, whole: set[Config]) -> Counter[Config]:
    """Whole sequences from a covering: the whole parts of the configurations in ``whole``, then those that fill a sequence,
    rounded up as long as their pieces last, then new ones that fill a sequence, then best fit."""
    left, kept, out, room = dict(counts), Counter(), Counter(), RESERVE * capacity
    for s in sorted(counts):
        kept[s] = min(left[s], -(-room // s)) if room > 0 else 0
        left[s] -= kept[s]
        room -= kept[s] * s

    def take(config: Config, most: int) -> None:
        if (n := min(most, *(left[s] // a for s, a in config))) > 0:
            out[config] += n
            for s, a in config:
                left[s] -= n * a

    for config in sorted(whole):
        take(config, int(covering.x[config] + 1e-6))
    full = [c for c in covering.x if sum(s * a for s, a in c) == capacity]
    for config in sorted(full, key=lambda c: (-covering.x[c], c)):
        take(config, math.ceil(covering.x[config] - 1e-6) - out[config])
    while any(left.values()):
        sizes = np.array(sorted(s for s in left if left[s]), np.int64)
        own, before = np.array([left[s] for s in sizes.tolist()]), out.total()
        best = _knapsack(sizes, sizes.astype(float), capacity)
        for k in range(len(sizes) - 1, -1, -1):
            while own[k] > 0 and (column := _exact_column(k, sizes, best, own)) is not None:
                i, a = column
                n = int((own[i] // a).min())
                take(tuple(sorted(zip(sizes[i].tolist(), a.tolist(), strict=True))), n)
                own[i] -= n * a
        if out.total() == before:
            break
    rest = Counter(left) + kept
    return out + best_fit({s: n for s, n in rest.items() if n}, capacity)


def best_fit(counts: dict[int, int], capacity: int) -> Counter[Config]:
    """Best fit, longest first, on counts alone: pieces go to the fullest sequences that still have room."""
    rooms: list[int] = []
    at: dict[int, Counter] = {}

    def put(room: int, config: Config, n: int) -> None:
        if room not in at:
            at[room] = Counter()
            insort(rooms, room)
        at[room][config] += n

    def add(config: Config, size: int, a: int) -> Config:
        return (*config, (size, a))

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            i = bisect_left(rooms, size)
            if i == len(rooms):
                a = capacity // size
                full, rest = divmod(left, a)
                if full:
                    put(capacity - a * size, ((size, a),), full)
                if rest:
                    put(capacity - rest * size, ((size, rest),), 1)
                left = 0
                continue
            room = rooms[i]
            group = at[room]
            config, n = next(iter(group.items()))
            a = min(room // size, left)
            take = min(n, left // a)
            group[config] -= take
            if not group[config]:
                del group[config]
            if not group:
                del at[room]
                rooms.pop(i)
            put(room - a * size, add(config, size, a), take)
            left -= a * take
    out: Counter[Config] = Counter()
    for group in at.values():
        for config, n in group.items():
            out[tuple(sorted(config))] += n
    return out


def plan(counts: dict[int, int], capacity: int) -> list[tuple[Config, int]]:
    """Whole sequences: (configuration, how many). Every piece of the histogram has exactly one place."""
    counts = {int(s): int(n) for s, n in counts.items() if n > 0}
    if any(s < 1 or s > capacity for s in counts):
        raise ValueError("lengths must lie between 1 and the capacity")
    out: Counter[Config] = Counter()
    if n := counts.pop(capacity, 0):
        out[((capacity, 1),)] = n
    if not counts:
        return sorted(out.items())
    covering = configuration_lp(counts, capacity)
    full = {c for c in covering.good if sum(s * a for s, a in c) == capacity}
    # Two roundings of the one covering: whether configurations with a small gap may come first depends on the lengths.
    out += min((_rounded(covering, counts, capacity, whole) for whole in (full, covering.good)), key=lambda c: c.total())
    return sorted(out.items())


def _places(configs: list[tuple[Config, int]]) -> dict[int, np.ndarray]:
    """For each length, by rank: first rank, copies a sequence, first sequence, first offset."""
    rows, used, sequence = defaultdict(list), Counter(), 0
    for config, n in configs:
        offset = 0
        for size, a in config:
            rows[size].append((used[size], a, sequence, offset))
            used[size] += n * a
            offset += size * a
        sequence += n
    return {size: np.array(r, np.int64) for size, r in rows.items()}


def pack(pieces: DataFrame, capacity: int, length_col: str = "length", order_by: list[str] | None = None) -> DataFrame:
    """Give every piece a ``sequence_id`` and an ``offset`` in it; other columns stay, and columns of these names are replaced.

    Sequences have no gaps and start at 0. Pieces must be 1 to ``capacity`` long. The order among pieces of one
    length decides nothing but which of them goes where; rows that are alike in every column are interchangeable.
    ``order_by``: columns that tell pieces apart (all of them by default).
    """
    spark = pieces.sparkSession
    pieces = pieces.drop("sequence_id", "offset")
    order = F.struct(*(order_by or [c for c in pieces.columns if c != length_col]))
    rows = pieces.select(F.struct("*").alias("row"), F.col(length_col).cast("long").alias("size"), order.alias("order"))
    histogram = rows.groupBy("size").count().toPandas()  # at most capacity rows
    counts = dict(zip(histogram["size"].tolist(), histogram["count"].tolist(), strict=True))
    places = _places(plan(counts, capacity))
    groups = max(1, min(sum(counts.values()) // RANK_ROWS, GROUPS * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    keyed = rows.withColumn("group", F.pmod(F.xxhash64("order"), F.lit(groups)))
    keyed = keyed.withColumn("rank", F.row_number().over(Window.partitionBy("size", "group").orderBy("order")) - 1)
    sums = keyed.groupBy("size", "group").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("size").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    keyed = keyed.join(sums.select("size", "group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), ["size", "group"])
    shared = spark.sparkContext.broadcast(places)  # bounded by the capacity and the columns, not by the corpus

    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        sizes, ranks = length.to_numpy(), rank.to_numpy()
        for size in np.unique(sizes):
            own = np.flatnonzero(sizes == size)
            rows = shared.value[int(size)]
            row = rows[np.searchsorted(rows[:, 0], ranks[own], "right") - 1]
            inside = ranks[own] - row[:, 0]
            sequence[own] = row[:, 2] + inside // row[:, 1]
            offset[own] = row[:, 3] + inside % row[:, 1] * size
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    placed = F.pandas_udf(place, "sequence_id long, offset long")
    return keyed.withColumn("place", placed(F.col("size"), F.col("rank") + F.col("before"))).select("row.*", "place.*")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, keep_ids: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, cut and pack: ``id_col, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``).

    Only documents longer than ``capacity`` ids (the end id counts) are cut, every ``capacity`` ids. A null or empty
    text is one piece of one id. An empty table gives no rows. Repeated rows are packed once each.
    """
    pieces = staged(encode_pieces(docs, tokenizer_path, end_id, capacity, id_col, text_col, keep_ids), "pieces")
    return pack(pieces, capacity, "length", [id_col, "piece", "start", "ids_crc32"])


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, n_ids, ids``: the ids of each sequence, joined in order; a sequence has at most the capacity. No pieces, no rows."""

    def join(table: pa.Table) -> pa.Table:
        table = table.sort_by("offset")
        raw = b"".join(table.column("ids").to_pylist())
        return pa.table({"sequence_id": table.column("sequence_id").slice(0, 1), "n_ids": pa.array([len(raw) // 4], pa.int64()), "ids": pa.array([raw], pa.binary())})

    return packed.select("sequence_id", "offset", "ids").groupBy("sequence_id").applyInArrow(join, "sequence_id long, n_ids long, ids binary")
