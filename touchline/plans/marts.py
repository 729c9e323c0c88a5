"""Registered queries over kinematics, drift, checks, funnels and incremental tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from touchline.operators.kinematics import arrival_time, control_share, halo_windows, smoothed
from touchline.operators.monitors import distribution_distance, stability_index, upper_cusum
from touchline.operators.quality import failures, orphans, reconciled, repeated_keys
from touchline.operators.tables import upsert
from touchline.plans.base import query
from touchline.sources.shared import shared_path, table

USER = ["user_id"]
TIME = ["ts", "event_id"]


@query("""
    WITH e AS (SELECT event_id, user_id, value, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n,
        lag(value, 6) OVER w AS b6, lag(value, 5) OVER w AS b5, lag(value, 4) OVER w AS b4, lag(value, 3) OVER w AS b3, lag(value, 2) OVER w AS b2, lag(value, 1) OVER w AS b1,
        lead(value, 1) OVER w AS a1, lead(value, 2) OVER w AS a2, lead(value, 3) OVER w AS a3, lead(value, 4) OVER w AS a4, lead(value, 5) OVER w AS a5, lead(value, 6) OVER w AS a6
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT event_id, user_id, round(CASE WHEN n < 7 THEN value
        WHEN i = 0 THEN (32 * value + 15 * a1 + 3 * a2 - 4 * a3 - 6 * a4 - 3 * a5 + 5 * a6) / 42
        WHEN i = 1 THEN (5 * b1 + 4 * value + 3 * a1 + 2 * a2 + a3 - a5) / 14
        WHEN i = 2 THEN (b2 + 3 * b1 + 4 * value + 4 * a1 + 3 * a2 + a3 - 2 * a4) / 14
        WHEN i = n - 3 THEN (a2 + 3 * a1 + 4 * value + 4 * b1 + 3 * b2 + b3 - 2 * b4) / 14
        WHEN i = n - 2 THEN (5 * a1 + 4 * value + 3 * b1 + 2 * b2 + b3 - b5) / 14
        WHEN i = n - 1 THEN (32 * value + 15 * b1 + 3 * b2 - 4 * b3 - 6 * b4 - 3 * b5 + 5 * b6) / 42
        ELSE (-2 * b3 + 3 * b2 + 6 * b1 + 7 * value + 6 * a1 + 3 * a2 - 2 * a3) / 21 END, 6) AS smoothed FROM e
""")
def w15_smoothed_positions(spark, d):
    return smoothed(table(spark, d, "events").select("event_id", "user_id", "ts", "value"), USER, TIME, "value").select("event_id", "user_id", F.round("smoothed", 6).alias("smoothed"))


@query("""
    WITH o AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS o, count(*) OVER (PARTITION BY user_id) AS n FROM events)
    SELECT event_id, user_id, w AS window_no, w <> o // 10 AS is_halo FROM (SELECT *, unnest(range(0, (n - 1) // 10 + 1)) AS w FROM o) WHERE o BETWEEN 10 * w - 3 AND 10 * w + 12
""")
def x01_halo_windows(spark, d):
    return halo_windows(table(spark, d, "events").select("event_id", "user_id", "ts"), USER, TIME, size=10, halo=3).drop("ts")


@query("""
    WITH p AS (SELECT ts, event_id, event_type = 'click' OR event_type = 'view' AS home, date_trunc('hour', ts) AS frame, value AS x, user_id % 68 AS y, (value % 7) - 3 AS vx, (user_id % 5) - 2 AS vy FROM events),
    a AS (SELECT frame, home, 52.5 - x AS dx, 34.0 - y AS dy, sqrt((52.5 - x) ** 2 + (34.0 - y) ** 2) AS d, vx, vy FROM p WHERE x IS NOT NULL),
    t AS (SELECT frame, home, 0.7 + (sqrt(v * v + 14 * d) - v) / 7 AS t FROM (SELECT *, CASE WHEN d > 0 THEN (vx * dx + vy * dy) / d ELSE 0 END AS v FROM a)),
    m AS (SELECT *, min(t) OVER (PARTITION BY frame) AS f FROM t)
    SELECT frame, count(*) AS n_players, round(sum(CASE WHEN home THEN 1 / (1 + exp((t - f) * pi() / sqrt(3.0) / 0.45)) ELSE 0 END) / sum(1 / (1 + exp((t - f) * pi() / sqrt(3.0) / 0.45))), 6) AS home_share FROM m GROUP BY frame
""")
def d01_pitch_control(spark, d):
    y, vx, vy = F.col("user_id") % 68, F.col("value") % 7 - 3, F.col("user_id") % 5 - 2
    players = table(spark, d, "events").where("value is not null").select(F.date_trunc("hour", "ts").alias("frame"), F.col("event_type").isin("click", "view").alias("home"), arrival_time(F.col("value"), y, vx, vy, F.lit(52.5), F.lit(34.0)).alias("t"))
    fastest = players.withColumn("f", F.min("t").over(Window.partitionBy("frame")))
    return fastest.groupBy("frame").agg(F.count(F.lit(1)).alias("n_players"), F.round(control_share(F.col("home"), F.col("t"), F.col("f")), 6).alias("home_share"))


@query("""
    WITH e AS (SELECT event_type, value, event_id % 3 = 1 AND value > 5 AS new FROM events WHERE value IS NOT NULL),
    s AS (SELECT event_type, min(value) FILTER (NOT new) AS low, max(value) FILTER (NOT new) AS high, count(*) FILTER (new) AS n, count(*) FILTER (NOT new) AS o FROM e GROUP BY 1),
    b AS (SELECT event_type, n, o, unnest(range(10)) AS k FROM s),
    c AS (SELECT event_type, least(floor((value - low) / (high - low) * 10), 9) AS k, count(*) FILTER (new) AS cn, count(*) FILTER (NOT new) AS co FROM e JOIN s USING (event_type) WHERE value BETWEEN low AND high GROUP BY 1, 2),
    p AS (SELECT b.event_type, coalesce(cn, 0) / b.n::DOUBLE + 1e-6::DOUBLE AS x, coalesce(co, 0) / b.o::DOUBLE + 1e-6::DOUBLE AS y FROM b LEFT JOIN c ON b.event_type = c.event_type AND b.k = c.k)
    SELECT event_type, round(greatest(sum((x - y) * ln(x / y)), 0), 6) AS psi FROM p GROUP BY 1
""")
def d23_stability_index(spark, d):
    """Shift of the values of a third of the events against the others: ten bins over the others' range."""
    return stability_index(table(spark, d, "events"), ["event_type"], "value", (F.col("event_id") % 3 == 1) & (F.col("value") > 5)).withColumn("psi", F.round("psi", 6))


@query("""
    WITH c AS (SELECT event_type, value, count(*) FILTER (WHERE event_id % 2 = 1) AS n, count(*) FILTER (WHERE event_id % 2 = 0) AS o FROM events WHERE value IS NOT NULL GROUP BY ALL),
    g AS (SELECT event_type, abs(sum(n) OVER b / sum(n) OVER w - sum(o) OVER b / sum(o) OVER w) AS gap FROM c WINDOW w AS (PARTITION BY event_type), b AS (PARTITION BY event_type ORDER BY value))
    SELECT event_type, round(max(gap), 6) AS ks FROM g GROUP BY event_type
""")
def d23_distribution_distance(spark, d):
    return distribution_distance(table(spark, d, "events").where("value is not null"), ["event_type"], "value", F.col("event_id") % 2 == 1, width=5).withColumn("ks", F.round("ks", 6))


@query("""
    WITH e AS (SELECT event_id, user_id, sum(coalesce(value, 0) - 55) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events)
    SELECT event_id, user_id, round(s - least(min(s) OVER (PARTITION BY user_id ORDER BY i), 0), 4) AS cusum FROM e
""")
def x10_upper_cusum(spark, d):
    rows = table(spark, d, "events").select("event_id", "user_id", "ts", "value")
    return upper_cusum(rows, USER, TIME, F.coalesce("value", F.lit(0.0)) - 55).select("event_id", "user_id", F.round("cusum", 4).alias("cusum"))


@query("""
    WITH t AS (SELECT user_id, event_type AS a, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events)
    SELECT least(a, b) AS node_1, greatest(a, b) AS node_2, count(*) FILTER (WHERE a <= b) AS forward, count(*) FILTER (WHERE a > b) AS backward FROM t WHERE b IS NOT NULL GROUP BY ALL HAVING count(*) >= 3
""")
def d28_transition_network(spark, d):
    after = F.lead("event_type").over(Window.partitionBy(*USER).orderBy(*TIME))
    pairs = table(spark, d, "events").select(F.col("event_type").alias("a"), after.alias("b")).where("b is not null")
    edges = pairs.groupBy(F.least("a", "b").alias("node_1"), F.greatest("a", "b").alias("node_2")).agg(F.count_if(F.expr("a <= b")).alias("forward"), F.count_if(F.expr("a > b")).alias("backward"))
    return edges.where("forward + backward >= 3")


def _expected_values(moves, goals, steps):
    """``value`` of each state after ``steps`` rounds of value = goal share + sum of move share * value of the next state.

    States are few (grid zones); each round joins tables of that size."""
    value = goals.select("state", F.lit(0.0).alias("value"))
    for _ in range(steps):
        ahead = moves.join(value.withColumnRenamed("state", "to_state"), "to_state").groupBy("state").agg(F.sum(F.col("share") * F.col("value")).alias("later"))
        value = goals.join(ahead, "state", "left").select("state", (F.col("goal_share") + F.coalesce("later", F.lit(0.0))).alias("value"))
    return value


@query("""
    WITH t AS (SELECT event_type AS state, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events),
    n AS (SELECT state, count(*) AS n FROM t GROUP BY state),
    m AS (SELECT t.state, t.b, count(*) / any_value(n.n) AS p FROM t JOIN n USING (state) WHERE b <> 'purchase' GROUP BY ALL),
    g AS (SELECT n.state, count(*) FILTER (WHERE t.b = 'purchase') / any_value(n.n) AS g FROM n JOIN t USING (state) GROUP BY n.state),
    v1 AS (SELECT state, g AS v FROM g),
    v2 AS (SELECT g.state, g.g + coalesce((SELECT sum(m.p * v1.v) FROM m JOIN v1 ON v1.state = m.b WHERE m.state = g.state), 0) AS v FROM g),
    v3 AS (SELECT g.state, g.g + coalesce((SELECT sum(m.p * v2.v) FROM m JOIN v2 ON v2.state = m.b WHERE m.state = g.state), 0) AS v FROM g)
    SELECT state, round(v, 6) AS expected_value FROM v3
""")
def d03_expected_value(spark, d):
    after = F.lead("event_type").over(Window.partitionBy(*USER).orderBy(*TIME))
    counts = table(spark, d, "events").select(F.col("event_type").alias("state"), after.alias("to_state")).groupBy("state", "to_state").agg(F.count(F.lit(1)).alias("n"))
    shares = counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("state")))
    goals = shares.groupBy("state").agg(F.coalesce(F.sum(F.when(F.col("to_state") == "purchase", F.col("share"))), F.lit(0.0)).alias("goal_share"))
    return _expected_values(shares.where("to_state <> 'purchase'"), goals, 3).select("state", F.round("value", 6).alias("expected_value"))


@query("""
    WITH s AS (SELECT user_id, max(event_type = 'view') AS viewed, max(event_type = 'click') AS clicked, max(event_type = 'purchase') AS bought, date_trunc('day', ts) AS day FROM events GROUP BY ALL)
    SELECT day, count(*) FILTER (WHERE viewed) AS n_viewed, count(*) FILTER (WHERE viewed AND clicked) AS n_clicked, count(*) FILTER (WHERE viewed AND clicked AND bought) AS n_bought FROM s GROUP BY day
""")
def a18_funnel(spark, d):
    did = lambda kind: F.bool_or(F.col("event_type") == kind)
    per_user = table(spark, d, "events").groupBy("user_id", F.date_trunc("day", "ts").alias("day")).agg(did("view").alias("v"), did("click").alias("c"), did("purchase").alias("b"))
    return per_user.groupBy("day").agg(F.count_if("v").alias("n_viewed"), F.count_if(F.expr("v and c")).alias("n_clicked"), F.count_if(F.expr("v and c and b")).alias("n_bought"))


@query("""
    WITH p AS (SELECT l_suppkey, least(greatest(l_discount * 5, 0.01), 0.99) AS p, l_returnflag = 'R' AS y FROM lineitem)
    SELECT l_suppkey, count(*) AS n, count(*) FILTER (WHERE y) AS actual, round(sum(p), 4) AS expected, round(sum(p) - 1.96 * sqrt(sum(p * (1 - p))), 4) AS low, round(sum(p) + 1.96 * sqrt(sum(p * (1 - p))), 4) AS high FROM p GROUP BY l_suppkey
""")
def a19_pooled_interval(spark, d):
    rows = table(spark, d, "lineitem").select("l_suppkey", F.least(F.greatest(F.col("l_discount") * 5, F.lit(0.01)), F.lit(0.99)).alias("p"), (F.col("l_returnflag") == "R").alias("y"))
    total, width = F.sum("p"), 1.96 * F.sqrt(F.sum(F.col("p") * (1 - F.col("p"))))
    return rows.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.count_if("y").alias("actual"), F.round(total, 4).alias("expected"), F.round(total - width, 4).alias("low"), F.round(total + width, 4).alias("high"))


@query("""SELECT l_orderkey, l_linenumber, round(l_quantity / sum(l_quantity) OVER (PARTITION BY l_orderkey), 10) AS share FROM lineitem""")
def a20_share_of_total(spark, d):
    whole = F.sum("l_quantity").over(Window.partitionBy("l_orderkey"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(F.col("l_quantity") / whole, 10).alias("share"))


@query("""
    WITH z AS (SELECT event_type, CASE WHEN value IS NOT NULL THEN least(greatest(floor(value / 10)::BIGINT, 0), 11) END AS zone FROM events)
    SELECT zone, count(*) FILTER (WHERE event_type = 'view') AS views, count(*) FILTER (WHERE event_type = 'click') AS clicks, count(*) FILTER (WHERE event_type = 'purchase') AS purchases, count(*) AS total FROM z GROUP BY zone
""")
def a15_grid_zones(spark, d):
    zone = F.when(F.col("value").isNotNull(), F.least(F.greatest(F.floor(F.col("value") / 10), F.lit(0)), F.lit(11)))
    of = lambda kind, name: F.count_if(F.col("event_type") == kind).alias(name)
    return table(spark, d, "events").groupBy(zone.alias("zone")).agg(of("view", "views"), of("click", "clicks"), of("purchase", "purchases"), F.count(F.lit(1)).alias("total"))


@query("""
    WITH e AS (SELECT *, coalesce(event_type <> lag(event_type) OVER w OR ts - lag(ts) OVER w > INTERVAL 6 HOUR, true) AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    s AS (SELECT *, sum(new::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS episode FROM e)
    SELECT user_id, episode::BIGINT AS episode, any_value(event_type) AS event_type, count(*) AS n_events, min(ts) AS starts, max(ts) AS ends FROM s GROUP BY user_id, episode HAVING count(*) >= 2
""")
def x05_episodes(spark, d):
    order = Window.partitionBy(*USER).orderBy(*TIME)
    fresh = (F.col("event_type") != F.lag("event_type").over(order)) | (F.col("ts") - F.lag("ts").over(order) > F.expr("interval 6 hours"))
    rows = table(spark, d, "events").withColumn("new", F.coalesce(fresh, F.lit(True)).cast("long")).withColumn("episode", F.sum("new").over(order))
    return rows.groupBy("user_id", "episode").agg(F.min("event_type").alias("event_type"), F.count(F.lit(1)).alias("n_events"), F.min("ts").alias("starts"), F.max("ts").alias("ends")).where("n_events >= 2")


@query("""
    SELECT 'price_positive' AS check_name, count(*) FILTER (WHERE NOT coalesce(o_totalprice > 0, false)) AS failures FROM orders
    UNION ALL SELECT 'status_known', count(*) FILTER (WHERE NOT coalesce(o_orderstatus IN ('O', 'F'), false)) FROM orders
    UNION ALL SELECT 'customer_present', count(*) FILTER (WHERE o_custkey IS NULL) FROM orders
""")
def q02_checks(spark, d):
    return failures(table(spark, d, "orders"), {"price_positive": F.col("o_totalprice") > 0, "status_known": F.col("o_orderstatus").isin("O", "F"), "customer_present": F.col("o_custkey").isNotNull()})


@query("""SELECT l_orderkey, l_suppkey, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def q02_repeated_keys(spark, d):
    return repeated_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_suppkey"])


@query("""SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM events WHERE event_id = o_orderkey)""")
def q02_orphans(spark, d):
    return orphans(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), table(spark, d, "events").select("event_id"), {"o_orderkey": "event_id"})


@query("""
    WITH a AS (SELECT o_orderkey AS k, o_totalprice AS t FROM orders), b AS (SELECT l_orderkey AS k, round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS t FROM lineitem GROUP BY 1)
    SELECT coalesce(a.k, b.k) AS order_key, a.t AS left_total, b.t AS right_total FROM a FULL JOIN b ON a.k = b.k WHERE coalesce(abs(a.t - b.t) > 0.05, true)
""")
def q06_reconciliation(spark, d):
    charged = F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))), 2)
    lines = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("order_key")).agg(charged.alias("total"))
    return reconciled(table(spark, d, "orders").select(F.col("o_orderkey").alias("order_key"), F.col("o_totalprice").alias("total")), lines, ["order_key"], "total", within=0.05)


@query("""
    WITH v AS (SELECT event_id, user_id, value, (value - lag(value) OVER w) / nullif(epoch_us(ts) - epoch_us(lag(ts) OVER w), 0) * 3600000000 AS speed FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT event_id, user_id, round(CASE WHEN abs(speed) <= 15 THEN speed END, 4) AS speed, coalesce(abs(speed) > 15, false) AS spike FROM v
""")
def q07_speed_spikes(spark, d):
    order = Window.partitionBy(*USER).orderBy(*TIME)
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    seconds = F.nullif(micros(F.col("ts")) - micros(F.lag("ts").over(order)), F.lit(0))
    rows = table(spark, d, "events").select("event_id", "user_id", ((F.col("value") - F.lag("value").over(order)) / seconds * 3600000000).alias("v"))
    return rows.select("event_id", "user_id", F.round(F.when(F.abs("v") <= 15, F.col("v")), 4).alias("speed"), F.coalesce(F.abs("v") > 15, F.lit(False)).alias("spike"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_custkey % 7 <> 0""")
def k07_delete_then_merge(spark, d):
    old = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    kept = old.where("o_custkey % 7 <> 0")
    return upsert(kept, kept.where("o_orderkey % 10 = 0").withColumn("o_orderstatus", F.lit("X")), ["o_orderkey"]).select("o_orderkey", "o_orderstatus")


@query("""SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders""")
def k10_replace_slices(spark, d):
    """Only the partitions that a write touches are replaced."""
    path = shared_path(spark, "slices")
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    rows.repartition("o_orderstatus", (F.col("o_orderkey") % 8)).write.partitionBy("o_orderstatus").parquet(path)
    changed = rows.where("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    changed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("o_orderstatus").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
