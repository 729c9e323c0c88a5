"""Registered queries over staging work: parsing, nested values, deduplication, guards and keyed writes, and their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from touchline.functions.parsing import access_tier, clock_seconds, exact_millimetres
from touchline.functions.pitch import grid_token, normalized, progressive
from touchline.plans.base import query
from touchline.sources.merging import merge
from touchline.sources.shared import shared_path, table


@query("""
    SELECT event_id, round(value / 100 * 120, 6) AS m_x, round((1 - (user_id % 68) / 68.0::DOUBLE) * 80, 6) AS m_y, round((value - 50 + 52.5) * (120 / 105.0::DOUBLE), 6) AS c_x,
        round(((user_id % 68) - 34 + 34) * (80 / 68.0::DOUBLE), 6) AS c_y, round(value * (120 / 105.0::DOUBLE), 6) AS p_x, round(value * 1.2::DOUBLE, 6) AS pct_x FROM events
""")
def f04_coordinate_systems(spark, d):
    x, y = F.col("value"), (F.col("user_id") % 68).cast("double")
    m, c, p, pct = normalized(x / 100, y / 68, "metrica"), normalized(x - 50, y - 34, "center_m"), normalized(x, y, "pitch_m"), normalized(x, y, "pct")
    columns = {"m_x": m[0], "m_y": m[1], "c_x": c[0], "c_y": c[1], "p_x": p[0], "pct_x": pct[0]}
    return table(spark, d, "events").select("event_id", *(F.round(v, 6).alias(k) for k, v in columns.items()))


@query("""
    WITH p AS (SELECT event_id, value AS x, (user_id % 80)::DOUBLE AS y, lead(value) OVER w AS ex, lead((user_id % 80)::DOUBLE) OVER w AS ey FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT event_id, sqrt((120 - ex) ** 2 + (40 - ey) ** 2) < 0.75::DOUBLE * sqrt((120 - x) ** 2 + (40 - y) ** 2) AS is_progressive FROM p
""")
def f06_progressive(spark, d):
    y, w = (F.col("user_id") % 80).cast("double"), Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = table(spark, d, "events").select("event_id", F.col("value").alias("x"), y.alias("y"), F.lead("value").over(w).alias("ex"), F.lead(y).over(w).alias("ey"))
    return rows.select("event_id", progressive(*map(F.col, ("x", "y", "ex", "ey"))).alias("is_progressive"))


@query("""
    WITH a AS (SELECT l_orderkey, list(l_quantity ORDER BY l_linenumber, l_partkey, l_quantity) AS q FROM lineitem GROUP BY 1)
    SELECT l_orderkey, q[1] AS first, q[3] AS third, len(q)::INTEGER AS n, len(list_filter(q, lambda x: x > 25))::INTEGER AS n_large, list_contains(q, q[1] + 1) AS has_next FROM a
""")
def f12_arrays(spark, d):
    q = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_quantity"))), lambda s: s["l_quantity"])
    rows = table(spark, d, "lineitem").groupBy("l_orderkey").agg(q.alias("q"))
    return rows.select("l_orderkey", F.get("q", F.lit(0)).alias("first"), F.get("q", F.lit(2)).alias("third"), F.size("q").alias("n"), F.size(F.filter("q", lambda x: x > 25)).alias("n_large"), F.array_contains("q", F.get("q", F.lit(0)) + 1).alias("has_next"))


@query("""
    SELECT event_id, CASE event_type WHEN 'view' THEN 'look' WHEN 'click' THEN 'touch' WHEN 'purchase' THEN 'goal' END AS kind FROM events
""")
def f13_map_lookup(spark, d):
    kinds = F.create_map(*(F.lit(x) for pair in {"view": "look", "click": "touch", "purchase": "goal"}.items() for x in pair))
    return table(spark, d, "events").select("event_id", F.try_element_at(kinds, F.col("event_type")).alias("kind"))


@query("""SELECT event_id, (props->>'k')::BIGINT AS k, json_array_length(json_array(event_id, user_id, value))::INTEGER AS n, event_id + user_id AS total FROM events""")
def f14_json_structs(spark, d):
    rows = table(spark, d, "events").select("event_id", F.from_json("props", "k long").alias("p"), F.to_json(F.array(F.col("event_id").cast("double"), F.col("user_id").cast("double"), "value")).alias("j"), F.to_json(F.create_map(F.lit("a"), "event_id", F.lit("b"), "user_id")).alias("m"))
    both = F.from_json("m", "map<string,long>")
    return rows.select("event_id", F.col("p.k").alias("k"), F.json_array_length("j").alias("n"), (F.element_at(both, "a") + F.element_at(both, "b")).alias("total"))


@query("""
    WITH a AS (SELECT l_orderkey, l_suppkey, list(l_linenumber ORDER BY l_linenumber) AS own FROM lineitem GROUP BY 1, 2)
    SELECT l_orderkey, l_suppkey, unnest(own) AS l_linenumber, unnest(range(1, len(own) + 1))::INTEGER AS place FROM a
""")
def f15_nested_generators(spark, d):
    """Order to a map of suppliers to lines, taken apart again by two generators in a row."""
    own = table(spark, d, "lineitem").groupBy("l_orderkey", "l_suppkey").agg(F.sort_array(F.collect_list("l_linenumber")).alias("own"))
    maps = own.groupBy("l_orderkey").agg(F.map_from_entries(F.collect_list(F.struct("l_suppkey", "own"))).alias("m"))
    pairs = maps.select("l_orderkey", F.explode("m").alias("l_suppkey", "own"))
    return pairs.select("l_orderkey", "l_suppkey", F.posexplode("own").alias("i", "l_linenumber")).select("l_orderkey", "l_suppkey", "l_linenumber", (F.col("i") + 1).alias("place"))


@query("""
    SELECT event_id, (extract(hour FROM ts) * 3600 + extract(minute FROM ts) * 60 + extract(second FROM ts))::DOUBLE AS clock, (extract(minute FROM ts) * 60 + extract(second FROM ts))::DOUBLE AS short_clock, NULL::DOUBLE AS wrong,
        (event_id % 1000 * 1000 + event_id % 997)::BIGINT AS mm FROM events
""")
def f16_strict_parsers(spark, d):
    written = F.concat((F.col("event_id") % 1000).cast("string"), F.lit("."), F.lpad((F.col("event_id") % 997).cast("string"), 3, "0"))
    clock = lambda form: clock_seconds(F.date_format("ts", form))
    return table(spark, d, "events").select("event_id", clock("HH:mm:ss").alias("clock"), clock("mm:ss").alias("short_clock"), clock("mm-ss").alias("wrong"), exact_millimetres(written).alias("mm"))


@query("""
    SELECT event_id, concat_ws('_', event_type, greatest(least(floor(value / 105 * 12)::INTEGER, 11), 0), greatest(least(floor((user_id % 68) / 68.0::DOUBLE * 8)::INTEGER, 7), 0)) AS token FROM events WHERE value IS NOT NULL
""")
def f20_grid_tokens(spark, d):
    return table(spark, d, "events").where("value is not null").select("event_id", grid_token(F.col("event_type"), F.col("value"), (F.col("user_id") % 68).cast("double")).alias("token"))


@query("""
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' OR (o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH')) THEN 'public' ELSE 'restricted' END AS tier FROM orders
""")
def f22_access_tier(spark, d):
    flag = F.when(F.col("o_orderstatus") == "F", "public").when(F.col("o_orderstatus") == "O", "restricted")
    return table(spark, d, "orders").select("o_orderkey", F.when(flag.isNull() & (F.col("o_orderstatus") != "P"), "restricted").otherwise(access_tier(flag, F.col("o_orderpriority"), ["1-URGENT", "2-HIGH"])).alias("tier"))


@query("""
    SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1
""")
def w08_latest_row_by_key(spark, d):
    """The latest row of each natural key: an aggregate, so that a hot key is combined before the shuffle."""
    best = F.max_by(F.struct("event_id", "value"), F.struct("ts", "event_id"))
    return table(spark, d, "events").groupBy("user_id", "event_type").agg(best.alias("b")).select("user_id", "event_type", "b.event_id", "b.value")


@query("""
    SELECT event_id, count(*) OVER (PARTITION BY user_id) AS size, row_number() OVER w - 1 AS cumcount, lag(event_id) OVER w AS shifted FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""")
def w12_group_transforms(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, d, "events").select("event_id", F.count(F.lit(1)).over(Window.partitionBy("user_id")).alias("size"), (F.row_number().over(w) - 1).cast("long").alias("cumcount"), F.lag("event_id").over(w).alias("shifted"))


@query("""
    WITH m AS (SELECT user_id, count(*) * 7 AS minutes FROM events GROUP BY 1)
    SELECT e.user_id, e.event_type, count(*) AS n, round(count(*) * 90.0::DOUBLE / nullif(any_value(m.minutes), 0), 3) AS per_90 FROM events e JOIN m ON m.user_id = e.user_id GROUP BY 1, 2
""")
def a12_per_90(spark, d):
    rows = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    minutes = rows.groupBy("user_id").agg((F.sum("n") * 7).alias("minutes"))
    return rows.join(minutes, "user_id").select("user_id", "event_type", "n", F.round(F.col("n") * F.lit(90.0) / F.nullif("minutes", F.lit(0)), 3).alias("per_90"))


@query("""
    WITH o AS (SELECT o_custkey, o_orderkey, string_agg(l_linenumber::VARCHAR, ',' ORDER BY l_linenumber) AS own FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2)
    SELECT o_custkey, string_agg(own, ';' ORDER BY o_orderkey) AS lines FROM o GROUP BY 1
""")
def a09_nested_arrays(spark, d):
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list("l_linenumber")).alias("own"))
    joined = table(spark, d, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    nested = joined.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "own"))).alias("all"))
    return nested.select("o_custkey", F.array_join(F.transform("all", lambda s: F.array_join(s["own"].cast("array<string>"), ",")), ";").alias("lines"))


@query("""SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM orders p WHERE p.o_custkey = o.o_custkey AND p.o_totalprice > o.o_totalprice)""")
def j13_not_exists_correlated(spark, d):
    """No order of the customer is dearer: the customer's largest price decides, instead of a join of all pairs."""
    orders = table(spark, d, "orders")
    top = orders.groupBy("o_custkey").agg(F.max("o_totalprice").alias("top"))
    return orders.join(top, "o_custkey").where("o_totalprice = top").select("o_orderkey")


@query("""
    SELECT p_partkey, (SELECT min(l_orderkey) FROM lineitem WHERE l_partkey = p_partkey OR l_suppkey = p_partkey) AS first_order FROM part
""")
def j20_either_side_lookup(spark, d):
    """Either side may match: one row a side and key, then an equi-join."""
    lines = table(spark, d, "lineitem")
    sides = lines.select(F.explode(F.array(F.col("l_partkey").cast("long"), F.col("l_suppkey").cast("long"))).alias("k"), "l_orderkey")
    first = sides.groupBy("k").agg(F.min("l_orderkey").alias("first_order"))
    return table(spark, d, "part").join(first, F.col("p_partkey") == F.col("k"), "left").select("p_partkey", "first_order")


@query("""
    SELECT a.o_orderkey AS left_key, b.o_orderkey AS right_key, abs(date_diff('day', a.o_orderdate::DATE, b.o_orderdate::DATE))::INTEGER AS days FROM orders a JOIN orders b
    ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey AND abs(date_diff('day', a.o_orderdate::DATE, b.o_orderdate::DATE)) <= 1
""")
def j27_a_day_apart(spark, d):
    """Candidates at most a day apart: the left side goes to three days, and the join is on (customer, day)."""
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    left = rows.select("o_custkey", F.col("o_orderkey").alias("left_key"), F.col("day").alias("own"), F.explode(F.array(*(F.date_add("day", i) for i in (-1, 0, 1)))).alias("day"))
    right = rows.withColumnRenamed("o_orderkey", "right_key")
    return left.join(right, ["o_custkey", "day"]).where("left_key < right_key").select("left_key", "right_key", F.abs(F.datediff("own", "day")).alias("days"))


@query("""SELECT o_orderkey, o_totalprice / (SELECT avg(o_totalprice) FROM orders) > 1 AS above FROM orders""")
def u08_scalar_subquery(spark, d):
    orders = table(spark, d, "orders")
    mean = orders.agg(F.avg("o_totalprice").alias("mean"))  # one row
    return orders.crossJoin(F.broadcast(mean)).select("o_orderkey", (F.col("o_totalprice") / F.col("mean") > 1).alias("above"))


@query("""SELECT n_name AS name FROM nation UNION SELECT r_name FROM region""")
def u04_union_distinct(spark, d):
    return table(spark, d, "nation").select(F.col("n_name").alias("name")).union(table(spark, d, "region").select("r_name")).distinct()


@query("""
    WITH g AS (SELECT o_custkey, count(DISTINCT o_orderstatus) AS n FROM orders GROUP BY 1)
    SELECT o_orderkey, n > 2 AS contaminated, CASE WHEN n <= 2 THEN o_totalprice END AS shown FROM orders JOIN g USING (o_custkey)
""")
def q04_contaminated_groups(spark, d):
    orders = table(spark, d, "orders")
    n = orders.groupBy("o_custkey").agg(F.countDistinct("o_orderstatus").alias("n"))
    return orders.join(n, "o_custkey").select("o_orderkey", (F.col("n") > 2).alias("contaminated"), F.when(F.col("n") <= 2, F.col("o_totalprice")).alias("shown"))


@query("""
    WITH e AS (SELECT l_orderkey, count(*) AS emitted, max(l_linenumber) AS expected FROM lineitem GROUP BY 1)
    SELECT l_orderkey, emitted, expected::BIGINT AS expected, emitted >= expected AS complete FROM e
""")
def q05_completeness(spark, d):
    e = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("emitted"), F.max("l_linenumber").cast("long").alias("expected"))
    return e.withColumn("complete", F.col("emitted") >= F.col("expected"))


@query("""
    SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 5 = 0 AND o_orderstatus = 'F' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders
    UNION ALL SELECT o_orderkey + 1000000000, 'F', 0.0 FROM orders WHERE o_orderkey % 11 = 0
""")
def k05_merge_into_parquet(spark, d):
    """A merge that is written: changed rows replace, new rows are added, and only the partition they belong to is rewritten."""
    path = shared_path(spark, "merged")
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    rows.write.partitionBy("o_orderstatus").parquet(path)
    changed = rows.where("o_orderkey % 5 = 0 and o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    added = rows.where("o_orderkey % 11 = 0").select((F.col("o_orderkey") + 1_000_000_000).alias("o_orderkey"), F.lit("F").alias("o_orderstatus"), F.lit(0.0).alias("o_totalprice"))
    merge(spark, path, changed.unionByName(added), ["o_orderkey", "o_orderstatus"], "o_orderstatus")
    return spark.read.schema(rows.schema).parquet(path)
