"""Registered queries that write tables and read them back: change sets, deletes, updates and stored marks."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.plans.base import query
from touchline.sources import merging
from touchline.sources.shared import shared_path, table


def _orders(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").alias("price"), F.col("o_orderdate").cast("date").cast("string").alias("day"))


def _next_day(rows):
    """The next snapshot: open orders close, prices of some rise, cancelled ones go, new ones come."""
    moved = rows.where("o_orderkey % 13 <> 0").withColumn("price", F.when(F.col("o_orderkey") % 7 == 0, F.col("price") + 1).otherwise(F.col("price")))
    moved = moved.withColumn("o_orderstatus", F.when((F.col("o_orderstatus") == "O") & (F.col("o_orderkey") % 3 == 0), "F").otherwise(F.col("o_orderstatus")))
    return moved.unionByName(rows.where("o_orderkey % 17 = 0").withColumn("o_orderkey", F.col("o_orderkey") + 1_000_000_000))


NEXT = """
    o AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice AS price, o_orderdate::DATE::VARCHAR AS day FROM orders),
    n AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'O' AND o_orderkey % 3 = 0 THEN 'F' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 7 = 0 THEN price + 1 ELSE price END AS price, day FROM o WHERE o_orderkey % 13 <> 0
        UNION ALL SELECT o_orderkey + 1000000000, o_custkey, o_orderstatus, price, day FROM o WHERE o_orderkey % 17 = 0)
"""


@query(f"""
    WITH {NEXT} SELECT coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey, coalesce(n.o_custkey, o.o_custkey) AS o_custkey, coalesce(n.o_orderstatus, o.o_orderstatus) AS o_orderstatus, coalesce(n.price, o.price) AS price, coalesce(n.day, o.day) AS day,
        CASE WHEN o.o_orderkey IS NULL THEN 'insert' WHEN n.o_orderkey IS NULL THEN 'delete' ELSE 'update' END AS change
    FROM n FULL JOIN o ON n.o_orderkey = o.o_orderkey WHERE o.o_orderkey IS NULL OR n.o_orderkey IS NULL OR n.price <> o.price OR n.o_orderstatus <> o.o_orderstatus
""")
def x06_change_set(spark, d):
    """What changed between two snapshots of the orders."""
    rows = _orders(spark, d)
    return merging.changes(rows, _next_day(rows), ["o_orderkey"])


@query(f"WITH {NEXT} SELECT * FROM n")
def k20_applied_changes(spark, d):
    """A stored copy of the first snapshot, brought to the second by the change set alone."""
    rows = _orders(spark, d)
    path = merging.folder(spark, rows, "o_orderstatus", "synced")
    merging.apply_changes(spark, path, merging.changes(rows, _next_day(rows), ["o_orderkey"]), ["o_orderkey"], "o_orderstatus")
    return spark.read.schema(rows.schema).parquet(path).select(rows.columns)


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice AS price, o_orderdate::DATE::VARCHAR AS day FROM orders WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0) AND NOT o_orderdate::DATE < DATE '1996-01-01'
""")
def k08_orphans_and_old_rows(spark, d):
    """A stored table after its orphans and its old rows are deleted."""
    rows = _orders(spark, d)
    path = merging.folder(spark, rows, "o_orderstatus", "kept")
    customers = table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    merging.delete_orphans(spark, path, customers, ["o_custkey"], "o_orderstatus")
    merging.delete_where(spark, path, F.col("day") < "1996-01-01", "o_orderstatus")
    return spark.read.schema(rows.schema).parquet(path).select(rows.columns)


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 5 = 0 AND o_orderstatus <> 'P' THEN NULL ELSE o_totalprice END AS price, o_orderdate::DATE::VARCHAR AS day FROM orders
""")
def k03_one_column_update(spark, d):
    """A stored table with one column of the matched rows set; orders still pending match nothing."""
    rows = _orders(spark, d)
    path = merging.folder(spark, rows, "o_orderstatus", "updated")
    new = rows.where("o_orderkey % 5 = 0 and o_orderstatus <> 'P'").select("o_orderkey", F.lit(None).cast("double").alias("price"))
    merging.update_column(spark, path, new, ["o_orderkey"], "price", "o_orderstatus")
    return spark.read.schema(rows.schema).parquet(path).select(rows.columns)


@query("""
    SELECT event_type AS source, max(ts) AS mark FROM events GROUP BY 1
""")
def k04_stored_marks(spark, d):
    """High-water marks stored in three merges: late halves, then all, then earlier ones that must not lower them."""
    path, rows = shared_path(spark, "marks"), table(spark, d, "events").select(F.col("event_type").alias("source"), F.col("ts").alias("mark"))
    for part in (rows.where("source <> 'error'"), rows, rows.where("mark < timestamp '2024-01-10'")):
        merging.raise_marks(spark, path, part.groupBy("source").agg(F.max("mark").alias("mark")))
    return merging.stored_marks(spark, path)
