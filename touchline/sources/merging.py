"""Keyed writes to partitioned Parquet folders: merges, one-column updates, deletes of orphans and of old rows, stored marks, and
change sets between stored snapshots.

A folder is changed by whole partitions: the new rows are written aside first and then swapped in; other partitions are neither read
nor written."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.operators.tables import upsert
from touchline.sources.shared import shared_path, staged

#: What a row of a change set does (fixed values).
INSERT, UPDATE, DELETE = "insert", "update", "delete"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on any store that Spark reads."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def _files(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def rewrite(spark: SparkSession, path: str, partition: str, touched: list, change: Callable[[DataFrame], DataFrame]) -> None:
    """Replace the partitions with a value in ``touched`` by ``change`` of their rows; a partition without rows left goes.

    The new rows are written aside first, so that a job that fails leaves the folder as it was; only the last step, which
    swaps the partitions, writes into it."""
    if not touched:
        return
    rows = spark.read.parquet(path)
    there = [x for x in touched if x is not None]
    own = rows.where(F.col(partition).isin(there) | (F.col(partition).isNull() if len(there) < len(touched) else F.lit(False)))
    aside = staged(change(own).select(rows.columns), "aside")
    left = {r[0] for r in aside.select(partition).distinct().collect()}  # a row a partition
    aside.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    for value in set(touched) - left:
        where, store = _files(spark, f"{path}/{partition}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}")
        store.delete(where, True)


def _touched(rows: DataFrame, partition: str) -> list:
    return [r[0] for r in rows.select(partition).distinct().collect()]  # a row a partition


def merge(spark: SparkSession, path: str, changes: DataFrame, keys: list[str], partition: str, newest: list[Column] | None = None) -> None:
    """Rows of equal keys are replaced, other rows of ``changes`` added; the folder is made if it is not there. The partition must
    follow from the keys. Of rows of ``changes`` with equal keys the first by ``newest`` stays, else the least by all columns."""
    order = newest or [F.col(c) for c in sorted(set(changes.columns) - set(keys))] or [F.lit(1)]
    once = changes.withColumn("__k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__k = 1").drop("__k")
    if not exists(spark, path):
        once.write.partitionBy(partition).parquet(path)
        return
    rewrite(spark, path, partition, _touched(once, partition), lambda own: upsert(own, once, keys))


def update_column(spark: SparkSession, path: str, changes: DataFrame, keys: list[str], column: str, partition: str) -> None:
    """Sets one column of the rows whose keys ``changes`` has (distinct); other columns and rows stay, nothing is added."""
    new = changes.select(*(F.col(k).alias(f"__{k}") for k in keys), F.col(column).alias("__new"), F.lit(True).alias("__hit"))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys))

    def change(own: DataFrame) -> DataFrame:
        return own.join(new, same, "left").withColumn(column, F.when(F.col("__hit"), F.col("__new")).otherwise(F.col(column)))

    rows = spark.read.parquet(path)
    rewrite(spark, path, partition, _touched(rows.join(new, same, "left_semi"), partition), change)


def delete_where(spark: SparkSession, path: str, gone: Column, partition: str) -> None:
    """Deletes the rows for which ``gone`` is true (old rows, for example); partitions without such rows stay as they are."""
    touched = _touched(spark.read.parquet(path).where(gone), partition)
    rewrite(spark, path, partition, touched, lambda own: own.where(~F.coalesce(gone, F.lit(False))))


def delete_orphans(spark: SparkSession, path: str, parents: DataFrame, keys: list[str], partition: str) -> None:
    """Deletes the rows without a row of equal keys in ``parents``; null keys match null keys."""
    known = parents.select(*(F.col(k).alias(f"__{k}") for k in keys)).distinct()
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys))
    touched = _touched(spark.read.parquet(path).join(known, same, "left_anti"), partition)
    rewrite(spark, path, partition, touched, lambda own: own.join(known, same, "left_semi"))


def raise_marks(spark: SparkSession, path: str, marks: DataFrame) -> None:
    """Stores high-water marks ``source, mark``: new sources are added, marks only rise, null marks change nothing.

    The table has a row a source; a new version is written aside and named last, so that readers see the old marks or the new ones."""
    old = stored_marks(spark, path)
    both = marks.select("source", "mark").where("mark is not null")
    both = both if old is None else old.unionByName(both)
    where, store = _files(spark, path)
    versions = sorted(int(x.getPath().getName().split("=")[1]) for x in store.listStatus(where)) if store.exists(where) else []
    both.groupBy("source").agg(F.max("mark").alias("mark")).coalesce(1).write.mode("overwrite").parquet(f"{path}/version={versions[-1] + 1 if versions else 0}")


def stored_marks(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest whole version of the marks below ``path``; None if there is none."""
    where, store = _files(spark, path)
    names = [x.getPath().getName() for x in store.listStatus(where)] if store.exists(where) else []
    whole = [int(n.split("=")[1]) for n in names if exists(spark, f"{path}/{n}/_SUCCESS")]
    return spark.read.parquet(f"{path}/version={max(whole)}") if whole else None


def row_hash(columns: list[str]) -> Column:
    """SHA-256 of a row's values as JSON: nulls, empty texts and borders of values are told apart."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def changes(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The row-level difference of two snapshots: the columns of ``new`` and ``change`` (insert, update, delete).

    Keys are distinct in each snapshot and null keys are equal; deleted rows have their old values. One shuffle of both sides by key."""
    columns = new.columns
    side = lambda rows: rows.select(F.struct(*keys).alias("__k"), F.struct(*columns).alias("r"), row_hash(columns).alias("h"))
    both = side(old.select(columns)).withColumn("__s", F.lit("o")).unionByName(side(new).withColumn("__s", F.lit("n")))
    of = lambda s, c: F.max(F.when(F.col("__s") == s, F.col(c)))
    pairs = both.groupBy("__k").agg(of("o", "r").alias("o"), of("n", "r").alias("n"), of("o", "h").alias("oh"), of("n", "h").alias("nh"))
    kind = F.when(F.col("oh").isNull(), INSERT).when(F.col("nh").isNull(), DELETE).when(F.col("oh") != F.col("nh"), UPDATE)
    return pairs.withColumn("change", kind).where("change is not null").select(F.coalesce("n", "o").alias("r"), "change").select("r.*", "change")


def apply_changes(spark: SparkSession, path: str, change_set: DataFrame, keys: list[str], partition: str) -> list:
    """Applies a change set to a stored snapshot and returns the partitions it rewrote: those that hold a changed row before or after."""
    change_set = staged(change_set, "changes")
    current = spark.read.parquet(path)
    hit = change_set.select(*(F.col(k).alias(f"__{k}") for k in keys))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys))
    touched = sorted(set(_touched(current.join(hit, same, "left_semi"), partition)) | set(_touched(change_set.where(F.col("change") != DELETE), partition)), key=str)
    rewrite(spark, path, partition, touched, lambda own: own.join(hit, same, "left_anti").unionByName(change_set.where(F.col("change") != DELETE).select(own.columns)))
    return touched


def folder(spark: SparkSession, rows: DataFrame, partition: str, name: str) -> str:
    """Writes rows to a new partitioned folder below the shared one; its path."""
    path = shared_path(spark, name)
    rows.write.partitionBy(partition).parquet(path)
    return path
