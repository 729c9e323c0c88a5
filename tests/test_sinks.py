"""Stored tables after merges, deletes and change sets."""

import glob
import os

import numpy as np
from pyspark.sql import functions as F
from touchline.operators.monitors import stability_index
from touchline.operators.vectors import longest_mean
from touchline.sources import merging

KIND = "k int, part string, v string, n int"
ROWS = [(1, "a", "x", 1), (2, "a", None, 2), (3, "b", "", 3), (4, "b", "y", None), (5, None, "z", 5), (6, "c", "w", 6)]


def stored(spark, path):
    return sorted((tuple(r) for r in spark.read.schema(KIND).parquet(path).select("k", "part", "v", "n").collect()), key=str)


def files(path, part):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/part={part}/*.parquet")}


def table(spark, tmp_path, rows=ROWS):
    path = f"{tmp_path}/t"
    spark.createDataFrame(rows, KIND).write.partitionBy("part").parquet(path)
    return path


def test_a_change_set_turns_the_old_snapshot_into_the_new(spark, tmp_path):
    path = table(spark, tmp_path)
    new = [(1, "a", "x", 1), (2, "a", "", 2), (3, "c", "", 3), (4, "b", "y", 0), (5, None, None, 5), (7, "d", "q", None)]
    old, fresh = spark.createDataFrame(ROWS, KIND), spark.createDataFrame(new, KIND)
    change = merging.changes(old, fresh, ["k"])
    assert {(r.k, r.change) for r in change.collect()} == {(2, "update"), (3, "update"), (4, "update"), (5, "update"), (6, "delete"), (7, "insert")}
    merging.apply_changes(spark, path, change, ["k"], "part")
    assert stored(spark, path) == sorted(new, key=str)
    assert merging.changes(fresh, fresh, ["k"]).count() == 0
    assert {r.change for r in merging.changes(fresh, old, ["k"]).collect()} == {"insert", "update", "delete"}


def test_unchanged_partitions_are_not_rewritten(spark, tmp_path):
    path = table(spark, tmp_path)
    before = files(path, "a")
    new = spark.createDataFrame([r for r in ROWS if r[0] != 6] + [(8, "b", "new", 8)], KIND)
    touched = merging.apply_changes(spark, path, merging.changes(spark.createDataFrame(ROWS, KIND), new, ["k"]), ["k"], "part")
    assert touched == ["b", "c"] and files(path, "a") == before and not glob.glob(f"{path}/part=c/*.parquet")
    assert merging.apply_changes(spark, path, merging.changes(new, new, ["k"]), ["k"], "part") == []


def test_merge_makes_the_folder_and_orders_repeated_keys(spark, tmp_path):
    path = f"{tmp_path}/new"
    rows = spark.createDataFrame([(1, "a", "old", 1), (1, "a", "new", 2), (2, "b", "x", 1)], KIND)
    merging.merge(spark, path, rows, ["k", "part"], "part", newest=[F.col("n").desc()])
    assert stored(spark, path) == [(1, "a", "new", 2), (2, "b", "x", 1)]
    merging.merge(spark, path, spark.createDataFrame([(1, "a", "newer", 3), (9, "c", "y", 1)], KIND), ["k", "part"], "part")
    assert stored(spark, path) == [(1, "a", "newer", 3), (2, "b", "x", 1), (9, "c", "y", 1)]


def test_deletes_and_updates(spark, tmp_path):
    path = table(spark, tmp_path)
    before = files(path, "a")
    merging.delete_orphans(spark, path, spark.createDataFrame([(k,) for k in (1, 2, 3, 5, 5)], "k int"), ["k"], "part")
    assert [r[0] for r in stored(spark, path)] == [1, 2, 3, 5] and files(path, "a") == before
    merging.update_column(spark, path, spark.createDataFrame([(2, "set"), (5, None), (77, "no")], "k int, v string"), ["k"], "v", "part")
    assert stored(spark, path) == [(1, "a", "x", 1), (2, "a", "set", 2), (3, "b", "", 3), (5, None, None, 5)]
    merging.delete_where(spark, path, F.col("n") < 3, "part")
    assert [r[0] for r in stored(spark, path)] == [3, 5]
    merging.delete_where(spark, path, F.col("n") > 99, "part")
    assert [r[0] for r in stored(spark, path)] == [3, 5]


def test_marks_only_rise(spark, tmp_path):
    path = f"{tmp_path}/marks"
    assert merging.stored_marks(spark, path) is None
    for rows in ([("a", 5), ("b", 1)], [("a", 3), ("b", 2), ("c", None)], [("d", 1)]):
        merging.raise_marks(spark, path, spark.createDataFrame(rows, "source string, mark long"))
    assert sorted(map(tuple, merging.stored_marks(spark, path).collect())) == [("a", 5), ("b", 2), ("d", 1)]
    os.remove(f"{path}/version=2/_SUCCESS")  # a version that was not finished
    assert sorted(map(tuple, merging.stored_marks(spark, path).collect())) == [("a", 5), ("b", 2)]


def test_stability_index_is_that_of_histograms(spark):
    rng = np.random.default_rng(1)
    rows, want = [], {}
    for g, (old, new) in {"near": (rng.normal(0, 1, 500), rng.normal(0.1, 1, 300)), "far": (rng.normal(0, 1, 400), rng.normal(3, 1, 100)), "one": (np.full(5, 2.0), np.array([2.0, 2.1, 9.0]))}.items():
        edges = np.histogram_bin_edges(old, bins=10)
        o, n = (np.histogram(x, bins=edges)[0] / len(x) + 1e-6 for x in (old, new))
        want[g] = max(float(((n - o) * np.log(n / o)).sum()), 0.0)
        rows += [(g, float(x), False) for x in old] + [(g, float(x), True) for x in new]
    rows += [("near", None, True), ("empty", 1.0, True)]
    got = {r.g: r.psi for r in stability_index(spark.createDataFrame(rows, "g string, v double, new boolean"), ["g"], "v", F.col("new")).collect()}
    assert got.pop("empty") is None and {g: round(x, 9) for g, x in got.items()} == {g: round(x, 9) for g, x in want.items()}


def test_only_the_longest_vectors_count(spark):
    """A player with vectors of two lengths is averaged over the longer ones."""
    rows = [(1, [1.0, 2.0]), (1, [9.0]), (1, [3.0, 6.0]), (2, [5.0]), (3, []), (3, None)]
    got = sorted(map(tuple, longest_mean(spark.createDataFrame(rows, "g int, v array<double>"), "g", "v").collect()))
    assert got == [(1, 0, 2.0, 2), (1, 1, 4.0, 2), (2, 0, 5.0, 1)]
