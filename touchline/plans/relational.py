"""Registered joins, aggregates, windows, set operations and scalar functions over plain tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from touchline.operators.temporal import asof_join
from touchline.plans.base import query
from touchline.sources.shared import table

def rows_counted() -> Column:
    return F.count(F.lit(1))


@query("""
    SELECT c_custkey, n_name AS nation, r_name AS region FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
""")
def j01_dimension_fan(spark, d):
    nations = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return table(spark, d, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", F.col("n_name").alias("nation"), F.col("r_name").alias("region"))


@query("""
    SELECT l_orderkey, l_linenumber, b.n_name AS buyer_nation, s.n_name AS seller_nation FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
    JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN nation b ON b.n_nationkey = c_nationkey LEFT JOIN nation s ON s.n_nationkey = s_nationkey WHERE l_returnflag = 'R'
""")
def j02_two_roles_of_one_dimension(spark, d):
    nation = lambda role: table(spark, d, "nation").select(F.col("n_nationkey").alias(f"{role}_key"), F.col("n_name").alias(f"{role}_nation"))
    lines = table(spark, d, "lineitem").where("l_returnflag = 'R'").select("l_orderkey", "l_linenumber", "l_suppkey")
    bought = lines.join(table(spark, d, "orders"), F.col("o_orderkey") == F.col("l_orderkey")).join(table(spark, d, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    sold = bought.join(table(spark, d, "supplier"), F.col("s_suppkey") == F.col("l_suppkey"))
    named = sold.join(nation("buyer"), F.col("c_nationkey") == F.col("buyer_key"), "left").join(nation("seller"), F.col("s_nationkey") == F.col("seller_key"), "left")
    return named.select("l_orderkey", "l_linenumber", "buyer_nation", "seller_nation")


@query("""
    WITH p AS (SELECT user_id, value AS price, ts AS price_start, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS price_end FROM events WHERE event_type = 'purchase')
    SELECT c.event_id, p.price FROM events c JOIN p ON p.user_id = c.user_id AND c.ts >= p.price_start AND (p.price_end IS NULL OR c.ts < p.price_end) WHERE c.event_type = 'click'
""")
def j07_slowly_changing_price(spark, d):
    """A price holds until the next one: the latest price at or before the click, without a product of a user's clicks and prices."""
    rows = table(spark, d, "events")
    clicks = rows.where("event_type = 'click'").select("user_id", "event_id", "ts")
    priced = asof_join(clicks, rows.where("event_type = 'purchase'"), ["user_id"], "ts", "event_id", ["value"])
    return priced.where("right_ts is not null").select("event_id", F.col("right_value").alias("price"))


@query("""
    SELECT l.l_orderkey, l.l_linenumber FROM lineitem l LEFT JOIN (SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity > 10) o
    ON o.l_orderkey = l.l_orderkey AND o.l_linenumber = l.l_linenumber WHERE o.l_orderkey IS NULL
""")
def j12_anti_on_composite_key(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return lines.join(lines.where("l_quantity > 10"), ["l_orderkey", "l_linenumber"], "left_anti").select("l_orderkey", "l_linenumber")


@query("""SELECT o_orderkey, o_totalprice FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')""")
def j14_semi(spark, d):
    returned = table(spark, d, "lineitem").where("l_returnflag = 'R'")
    return table(spark, d, "orders").join(returned, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_orderkey", "o_totalprice")


@query("""
    WITH t AS (SELECT c_nationkey AS nation, c_mktsegment AS team, count(*) AS n FROM customer GROUP BY 1, 2)
    SELECT a.nation, a.team, b.team AS opponent, a.n - b.n AS ahead FROM t a JOIN t b ON a.nation = b.nation AND a.team <> b.team
""")
def j15_unequal_teams(spark, d):
    teams = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("team")).agg(rows_counted().alias("n"))
    other = teams.select("nation", F.col("team").alias("opponent"), F.col("n").alias("theirs"))
    return teams.join(other, "nation").where("team <> opponent").select("nation", "team", "opponent", (F.col("n") - F.col("theirs")).alias("ahead"))


@query("""
    WITH z AS (SELECT *, greatest(least(floor(value / 10)::INTEGER, 15), 0) AS zone FROM events WHERE value IS NOT NULL),
    g AS (SELECT zone, count(*) AS weight FROM z GROUP BY 1), m AS (SELECT event_id, zone, lead(zone) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_zone FROM z)
    SELECT event_id, m.zone AS start_zone, next_zone AS end_zone, b.weight - a.weight AS gained FROM m JOIN g a ON a.zone = m.zone JOIN g b ON b.zone = next_zone
""")
def j16_grid_twice(spark, d):
    rows = table(spark, d, "events").where("value is not null").withColumn("zone", F.greatest(F.least(F.floor(F.col("value") / 10).cast("int"), F.lit(15)), F.lit(0)))
    grid = rows.groupBy("zone").agg(rows_counted().alias("weight"))  # 16 zones at most
    side = lambda name: F.broadcast(grid.select(F.col("zone").alias(f"{name}_zone"), F.col("weight").alias(f"{name}_weight")))
    moves = rows.select("event_id", F.col("zone").alias("start_zone"), F.lead("zone").over(Window.partitionBy("user_id").orderBy("ts", "event_id")).alias("end_zone"))
    return moves.join(side("start"), "start_zone").join(side("end"), "end_zone").select("event_id", "start_zone", "end_zone", (F.col("end_weight") - F.col("start_weight")).alias("gained"))


@query("""
    SELECT c_custkey, (SELECT o_orderkey FROM orders WHERE o_custkey = c_custkey ORDER BY o_orderpriority, o_orderdate DESC, o_orderkey LIMIT 1) AS best_order FROM customer
""")
def j19_best_by_priority(spark, d):
    best = table(spark, d, "orders").groupBy("o_custkey").agg(F.min_by("o_orderkey", F.struct("o_orderpriority", -F.unix_micros(F.col("o_orderdate").cast("timestamp")), "o_orderkey")).alias("best_order"))
    return table(spark, d, "customer").join(best, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "best_order")


@query("""
    WITH p AS (SELECT user_id, max(value) AS v FROM events WHERE event_type = 'purchase' AND value > 60 GROUP BY 1), k AS (SELECT user_id, max(value) AS v FROM events WHERE event_type = 'click' GROUP BY 1)
    SELECT u.user_id, coalesce(p.v, k.v, 0.0)::DOUBLE AS position FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN p ON p.user_id = u.user_id LEFT JOIN k ON k.user_id = u.user_id
""")
def j24_fallback_chain(spark, d):
    top = lambda condition: F.max(F.when(F.expr(condition), F.col("value")))
    return table(spark, d, "events").groupBy("user_id").agg(F.coalesce(top("event_type = 'purchase' and value > 60"), top("event_type = 'click'"), F.lit(0.0)).alias("position"))


@query("""
    SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, count(*) FILTER (l_returnflag = 'R') AS returned, round(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END), 4) AS quantity, count(DISTINCT l_suppkey) AS suppliers
    FROM lineitem GROUP BY 1 HAVING count(*) > 2
""")
def a03_conditional_sums(spark, d):
    returned = F.col("l_returnflag") == "R"
    days = table(spark, d, "lineitem").groupBy(F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"))
    out = days.agg(F.count_if(returned).alias("returned"), F.round(F.sum(F.when(returned, F.col("l_quantity")).otherwise(0.0)), 4).alias("quantity"), F.countDistinct("l_suppkey").alias("suppliers"), rows_counted().alias("n"))
    return out.where("n > 2").drop("n")


@query("""SELECT l_orderkey, string_agg(l_partkey::VARCHAR, ',' ORDER BY l_linenumber, l_partkey) AS parts FROM lineitem GROUP BY 1""")
def a08_ordered_arrays(spark, d):
    ordered = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey")))
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.transform(ordered, lambda x: x["l_partkey"].cast("string")), ",").alias("parts"))


@query("""
    SELECT l_suppkey, round(sum(l_discount * l_quantity) / nullif(sum(l_quantity), 0), 9) AS mean_discount, round(100.0 * count(*) FILTER (l_returnflag = 'R') / count(*), 6)::DOUBLE AS returned_pct FROM lineitem GROUP BY 1
""")
def a11_weighted_mean(spark, d):
    mean = F.sum(F.col("l_discount") * F.col("l_quantity")) / F.nullif(F.sum("l_quantity"), F.lit(0.0))
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.round(mean, 9).alias("mean_discount"), F.round(F.lit(100.0) * F.count_if(F.col("l_returnflag") == "R") / rows_counted(), 6).alias("returned_pct"))


@query("""
    SELECT user_id, event_type AS dominant, n FROM (SELECT user_id, event_type, count(*) AS n, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS r FROM events GROUP BY 1, 2) WHERE r = 1
""")
def a13_dominant_category(spark, d):
    counted = table(spark, d, "events").groupBy("user_id", "event_type").agg(rows_counted().alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("less"), "event_type"))
    return counted.groupBy("user_id").agg(best.alias("best")).select("user_id", F.col("best.event_type").alias("dominant"), (-F.col("best.less")).alias("n"))


@query("""
    SELECT (floor(l_quantity / 10) * 10 + 5)::DOUBLE AS x, (floor(l_discount * 100 / 2) * 2 + 1)::DOUBLE AS y, count(*) AS n FROM lineitem GROUP BY 1, 2
""")
def a14_histogram(spark, d):
    centre = lambda c, width: (F.floor(c / width) * width + width / 2).cast("double")
    return table(spark, d, "lineitem").groupBy(centre(F.col("l_quantity"), 10).alias("x"), centre(F.col("l_discount") * 100, 2).alias("y")).agg(rows_counted().alias("n"))


@query("""
    SELECT c_nationkey, c_custkey, round(coalesce((c_acctbal - avg(c_acctbal) OVER w) / nullif(stddev_pop(c_acctbal) OVER w, 0), CASE WHEN c_acctbal IS NOT NULL THEN 0.0 END), 6)::DOUBLE AS z FROM customer WINDOW w AS (PARTITION BY c_nationkey)
""")
def a23_z_scores(spark, d):
    rows = table(spark, d, "customer").select("c_nationkey", "c_custkey", "c_acctbal")
    stats = rows.groupBy("c_nationkey").agg(F.avg("c_acctbal").alias("mean"), F.nullif(F.stddev_pop("c_acctbal"), F.lit(0.0)).alias("deviation"))
    z = F.coalesce((F.col("c_acctbal") - F.col("mean")) / F.col("deviation"), F.when(F.col("c_acctbal").isNotNull(), 0.0))
    return rows.join(stats, "c_nationkey").select("c_nationkey", "c_custkey", F.round(z, 6).alias("z"))


@query("""SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""")
def a25_cube(spark, d):
    return table(spark, d, "orders").cube("o_orderstatus", "o_orderpriority").agg(rows_counted().alias("n"))


@query("""
    SELECT event_id, round((value - lag(value) OVER w) / nullif((epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 1e6, 0), 6)::DOUBLE + 0.0::DOUBLE AS velocity, lead(event_type) OVER w AS next_type FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""")
def w04_velocity_and_next(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    took = F.nullif((micros - F.lag(micros).over(w)) / F.lit(1e6), F.lit(0.0))
    return table(spark, d, "events").select("event_id", F.round((F.col("value") - F.lag("value").over(w)) / took, 6).alias("velocity"), F.lead("event_type").over(w).alias("next_type"))


@query("""
    SELECT o_orderkey, round(percent_rank() OVER w, 9) AS price_rank, dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) - 1 AS ordinal FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_totalprice)
""")
def w05_percent_and_dense_rank(spark, d):
    w = Window.partitionBy("o_custkey")
    return table(spark, d, "orders").select("o_orderkey", F.round(F.percent_rank().over(w.orderBy("o_totalprice")), 9).alias("price_rank"), (F.dense_rank().over(w.orderBy("o_orderpriority")) - 1).cast("long").alias("ordinal"))


@query("""SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_totalprice FROM orders ORDER BY o_custkey, o_orderdate DESC NULLS LAST, o_orderkey""")
def w11_distinct_on(spark, d):
    w = Window.partitionBy("o_custkey").orderBy(F.desc_nulls_last("o_orderdate"), "o_orderkey")
    return table(spark, d, "orders").withColumn("r", F.row_number().over(w)).where("r = 1").select("o_custkey", "o_orderkey", "o_totalprice")


@query("""SELECT c_custkey, c_acctbal FROM customer ORDER BY abs(c_acctbal - 5000) DESC, c_custkey LIMIT 25""")
def l02_top_by_distance(spark, d):
    return table(spark, d, "customer").select("c_custkey", "c_acctbal").orderBy(F.abs(F.col("c_acctbal") - 5000).desc(), "c_custkey").limit(25)


@query("""SELECT 'customer' AS kind, c_custkey AS id, c_acctbal AS amount, c_mktsegment AS segment FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_acctbal, NULL FROM supplier""")
def u01_union_of_branches(spark, d):
    customers = table(spark, d, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("amount"), F.col("c_mktsegment").alias("segment"))
    suppliers = table(spark, d, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("amount"))
    return customers.unionByName(suppliers, allowMissingColumns=True)


@query("""
    WITH a AS (SELECT user_id FROM events WHERE event_type = 'purchase'), b AS (SELECT user_id FROM events WHERE event_type = 'error')
    (SELECT user_id FROM a EXCEPT SELECT user_id FROM b) UNION ALL (SELECT user_id FROM b EXCEPT SELECT user_id FROM a)
""")
def u03_symmetric_difference(spark, d):
    has = lambda kind: F.bool_or(F.col("event_type") == kind)
    return table(spark, d, "events").groupBy("user_id").agg(has("purchase").alias("a"), has("error").alias("b")).where("a <> b").select("user_id")


@query("""SELECT user_id FROM events WHERE event_type = 'purchase' INTERSECT SELECT user_id FROM events WHERE event_type = 'error'""")
def u06_intersect(spark, d):
    users = lambda kind: table(spark, d, "events").where(F.col("event_type") == kind).select("user_id")
    return users("purchase").intersect(users("error"))


@query("""
    WITH s AS (SELECT l_orderkey, l_linenumber, l_quantity AS x, l_discount * 100 AS y FROM lineitem)
    SELECT l_orderkey, l_linenumber, round(sqrt(power(105 - x, 2) + power(34 - y, 2)), 6) AS goal_distance, round(abs(atan2(7.32 * (105 - x), power(105 - x, 2) + power(34 - y, 2) - power(3.66, 2))), 6) AS goal_angle FROM s
""")
def f03_goal_geometry(spark, d):
    dx, dy = F.lit(105) - F.col("l_quantity"), F.lit(34) - F.col("l_discount") * 100
    squared = F.pow(dx, F.lit(2)) + F.pow(dy, F.lit(2))
    angle = F.abs(F.atan2(F.lit(7.32) * dx, squared - F.pow(F.lit(3.66), F.lit(2))))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(F.sqrt(squared), 6).alias("goal_distance"), F.round(angle, 6).alias("goal_angle"))


@query(r"""
    SELECT p_partkey, upper(p_brand) AS brand, regexp_extract(p_brand, '#([0-9]+)', 1) AS number, split_part(p_name, ' ', 1) AS colour, concat_ws('-', lower(p_type), p_size::VARCHAR) AS tag, regexp_matches(p_brand, '^Brand#[0-9]$') AS plain FROM part
""")
def f07_strings(spark, d):
    return table(spark, d, "part").select(
        "p_partkey",
        F.upper("p_brand").alias("brand"),
        F.regexp_extract("p_brand", "#([0-9]+)", 1).alias("number"),
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("colour"),
        F.concat_ws("-", F.lower("p_type"), F.col("p_size").cast("string")).alias("tag"),
        F.col("p_brand").rlike("^Brand#[0-9]$").alias("plain"),
    )


@query("""
    SELECT event_id, (CASE event_id % 5 WHEN 0 THEN 0 WHEN 1 THEN 2700 WHEN 2 THEN 5400 WHEN 3 THEN 6300 ELSE 7200 END + second(ts))::BIGINT AS match_clock, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS shown FROM events
""")
def f11_match_clock_and_mask(spark, d):
    # Seconds at which each period starts.
    starts = F.element_at(F.array(*(F.lit(x) for x in (0, 2700, 5400, 6300, 7200))), (F.col("event_id") % 5 + 1).cast("int"))
    return table(spark, d, "events").select("event_id", (starts + F.second("ts")).cast("long").alias("match_clock"), F.when(F.col("event_type") != "error", F.col("value")).alias("shown"))


@query("""
    SELECT l_returnflag, count(*) AS n, sum(('0x' || substr(md5(concat_ws('|', l_orderkey::VARCHAR, l_linenumber::VARCHAR, l_partkey::VARCHAR)), 1, 8))::BIGINT)::BIGINT AS checksum FROM lineitem GROUP BY 1
""")
def k18_copy_checksum(spark, d):
    digest = F.md5(F.concat_ws("|", *(F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey"))))
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(rows_counted().alias("n"), F.sum(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")).alias("checksum"))
