"""Registered queries over feeds' field maps, control surfaces, networks, drift and keyed state, and their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from touchline.operators.kinematics import control_surface
from touchline.operators.monitors import transport_distance
from touchline.operators.temporal import lead_in_parts
from touchline.operators.vectors import longest_mean
from touchline.plans.base import query
from touchline.sources.fields import Field, csv_fields, json_fields, xml_fields
from touchline.sources.shared import shared_path, table

USER = ["user_id"]
TIME = ["ts", "event_id"]


@query("""
    SELECT o_orderkey AS order_id, o_custkey AS customer, o_totalprice AS price, o_orderpriority AS first_tag, NULL::BIGINT AS referee, '{"id":' || o_custkey || '}' AS customer_json FROM orders
""")
def s10_json_fields(spark, d):
    path = shared_path(spark, "json-feed")
    nested = F.struct(F.col("o_orderkey").alias("id"), F.struct(F.col("o_custkey").alias("id")).alias("customer"), F.col("o_totalprice").alias("price"), F.array("o_orderpriority").alias("tags"))
    table(spark, d, "orders").select(F.to_json(nested).alias("value")).write.text(path)
    fields = [
        Field("order_id", "$.id", "bigint", required=True), Field("customer", "$.customer.id", "bigint"), Field("price", "$.price", "double"),
        Field("first_tag", "$.tags[0]"), Field("referee", "$.referee.id", "bigint"), Field("customer_json", "$.customer", "json"),
    ]
    return json_fields(spark.read.text(path), fields)


@query("""SELECT c_custkey AS customer, c_name AS name, c_acctbal AS balance, c_nationkey::INTEGER AS nation, NULL::DOUBLE AS rating FROM customer""")
def s11_csv_fields(spark, d):
    path = shared_path(spark, "csv-feed")
    table(spark, d, "customer").write.option("header", True).csv(path)
    fields = [Field("customer", "c_custkey", "bigint", required=True), Field("name", "c_name"), Field("balance", "c_acctbal", "double"), Field("nation", "c_nationkey", "int"), Field("rating", "c_rating", "double")]
    return csv_fields(spark, path, fields)


@query("""
    SELECT o_orderkey AS order_id, o_totalprice AS price, o_orderpriority = '1-URGENT' AS urgent, CASE WHEN o_custkey % 2 = 0 THEN '' ELSE concat_ws(',', o_custkey, o_custkey + 1) END AS line_ids FROM orders
""")
def s12_xml_fields(spark, d):
    path = shared_path(spark, "xml-feed")
    line = lambda n: F.struct((F.col("o_custkey") + n).alias("_id"))
    element = [
        F.col("o_orderkey").alias("_id"), F.struct(F.col("o_totalprice").alias("_amount")).alias("price"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "x").alias("urgent"), F.when(F.col("o_custkey") % 2 != 0, F.array(line(0), line(1))).alias("line"),
    ]
    table(spark, d, "orders").select(*element).write.format("xml").option("rootTag", "orders").option("rowTag", "order").save(path)
    fields = [Field("order_id", "@id", "bigint", required=True), Field("price", "price/@amount", "double"), Field("urgent", "urgent?"), Field("lines", "line[]/@id", "bigint")]
    return xml_fields(spark, path, "order", fields).select("order_id", "price", "urgent", F.array_join(F.col("lines").cast("array<string>"), ",").alias("line_ids"))


@query("""
    WITH p AS (SELECT date_trunc('hour', ts) AS frame, event_type = 'click' OR event_type = 'view' AS home, value AS x, user_id % 68 AS y, (value % 7) - 3 AS vx, (user_id % 5) - 2 AS vy FROM events WHERE value IS NOT NULL),
    g AS (SELECT c AS cell, (c % 50) * (105.0::DOUBLE / 49) AS gx, (c // 50) * (68.0::DOUBLE / 31) AS gy FROM range(1600) r(c)),
    e AS (SELECT frame, cell, home, vx, vy, gx - x AS dx, gy - y AS dy, sqrt((gx - x) ** 2 + (gy - y) ** 2) AS d FROM p, g),
    t AS (SELECT frame, cell, home, greatest(0.7, 0.7 + (sqrt(v * v + 14 * d) - v) / 7) AS t FROM (SELECT *, CASE WHEN d > 0 THEN (vx * dx + vy * dy) / d ELSE 0 END AS v FROM e)),
    m AS (SELECT frame, cell, min(t) FILTER (WHERE home) AS h, min(t) FILTER (WHERE NOT home) AS w FROM t GROUP BY ALL),
    i AS (SELECT frame, cell, any_value(h) AS h, any_value(w) AS w, sum(CASE WHEN home THEN v END) AS hi, sum(CASE WHEN NOT home THEN v END) AS wi
        FROM (SELECT frame, cell, home, h, w, 1 / (1 + exp(greatest(-50, least(50, (t - CASE WHEN home THEN w ELSE h END) * pi() / sqrt(3.0) / 0.45)))) AS v FROM t JOIN m USING (frame, cell)) GROUP BY ALL)
    SELECT frame, cell::INTEGER AS cell, round(CASE WHEN w IS NULL THEN 1 WHEN h IS NULL THEN 0 WHEN hi + wi > 1e-10 THEN hi / (hi + wi) ELSE 0.5 END, 6)::DOUBLE AS home_control FROM i
""")
def d01_pitch_surface(spark, d):
    place = [F.date_trunc("hour", "ts").alias("frame"), "event_type", F.col("value").alias("x"), (F.col("user_id") % 68).alias("y"), (F.col("value") % 7 - 3).alias("vx"), (F.col("user_id") % 5 - 2).alias("vy")]
    surface = control_surface(table(spark, d, "events").select(*place), ["frame"], F.col("event_type").isin("click", "view"))
    return surface.withColumn("home_control", F.round("home_control", 6))


@query("""
    WITH t AS (SELECT user_id AS a, value AS x, lead(user_id) OVER w AS b, lead(value) OVER w AS bx FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id))
    SELECT node, count(*) AS n_places, round(sum(x), 2) / count(x) AS mean_x FROM (SELECT a AS node, x FROM t WHERE b IS NOT NULL UNION ALL SELECT b, bx FROM t WHERE b IS NOT NULL) GROUP BY node
""")
def d28_network_nodes(spark, d):
    places = table(spark, d, "events").select("event_type", *TIME, F.col("user_id").alias("a"), F.col("value").alias("x"))
    moves = lead_in_parts(places, ["event_type"], F.date_trunc("hour", "ts"), TIME, {"a": "b", "x": "bx"}).where("b is not null")
    ends = moves.select(F.explode(F.array(F.struct(F.col("a").alias("node"), "x"), F.struct(F.col("b").alias("node"), F.col("bx").alias("x")))).alias("e"))
    return ends.groupBy("e.node").agg(F.count(F.lit(1)).alias("n_places"), F.try_divide(F.round(F.sum("e.x"), 2), F.count("e.x")).alias("mean_x"))


@query("""
    WITH t AS (SELECT event_type AS from_node, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS to_node FROM events)
    SELECT from_node, to_node, count(*) AS n FROM t WHERE to_node IS NOT NULL GROUP BY ALL HAVING count(*) >= 3
""")
def d28_directed_edges(spark, d):
    after = F.lead("event_type").over(Window.partitionBy(*USER).orderBy(*TIME))
    moves = table(spark, d, "events").select(F.col("event_type").alias("from_node"), after.alias("to_node")).where("to_node is not null")
    return moves.groupBy("from_node", "to_node").agg(F.count(F.lit(1)).alias("n")).where("n >= 3")


@query("""
    WITH c AS (SELECT event_type, value, count(*) FILTER (WHERE event_id % 2 = 1) AS n, count(*) FILTER (WHERE event_id % 2 = 0) AS o FROM events WHERE value IS NOT NULL GROUP BY ALL),
    g AS (SELECT event_type, abs(sum(n) OVER b / sum(n) OVER w - sum(o) OVER b / sum(o) OVER w) * (lead(value) OVER b - value) AS area FROM c WINDOW w AS (PARTITION BY event_type), b AS (PARTITION BY event_type ORDER BY value))
    SELECT event_type, round(sum(area), 6) AS wasserstein FROM g GROUP BY event_type
""")
def d23_transport_distance(spark, d):
    return transport_distance(table(spark, d, "events"), ["event_type"], "value", F.col("event_id") % 2 == 1, width=5).withColumn("wasserstein", F.round("wasserstein", 6))


@query("""
    SELECT event_type, min(value) AS least, max(value) AS most, count(*) FILTER (WHERE value IS NULL) AS n_null, count(*) FILTER (WHERE value < 1 OR value > 99) AS n_outside FROM events GROUP BY event_type
""")
def d23_bounds(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.min("value").alias("least"), F.max("value").alias("most"), F.count_if(F.col("value").isNull()).alias("n_null"), F.count_if(~F.col("value").between(1, 99)).alias("n_outside"))


@query("""
    SELECT DISTINCT user_id, first_value(event_type) OVER w AS first_type, last_value(event_type) OVER w AS last_type FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
""")
def a06_first_and_last(spark, d):
    at = F.struct("ts", "event_id")
    return table(spark, d, "events").groupBy("user_id").agg(F.min_by("event_type", at).alias("first_type"), F.max_by("event_type", at).alias("last_type"))


@query("""
    WITH m AS (SELECT user_id, ts::DATE AS day, list(value ORDER BY ts, event_id) AS v FROM events WHERE value IS NOT NULL GROUP BY 1, 2),
    b AS (SELECT user_id, max(len(v)) AS n FROM m GROUP BY 1),
    e AS (SELECT user_id, generate_subscripts(v, 1) - 1 AS p, unnest(v) AS x FROM m JOIN b USING (user_id) WHERE len(v) = n)
    SELECT user_id, p::INTEGER AS position, round(avg(x), 6) AS mean, count(*) AS n_vectors FROM e GROUP BY 1, 2
""")
def a10_longest_vectors(spark, d):
    """Each user's days as vectors of values: the element-wise mean of those of the user's greatest length."""
    at = F.sort_array(F.collect_list(F.struct("ts", "event_id", "value")))
    days = table(spark, d, "events").where("value is not null").groupBy("user_id", F.to_date("ts").alias("day")).agg(at.alias("v"))  # a user's day
    own = longest_mean(days.select("user_id", F.transform("v", lambda x: x["value"]).alias("v")), "user_id", "v")
    return own.withColumn("mean", F.round("mean", 6))


@query("""
    WITH v AS (SELECT label, generate_subscripts(embedding, 1) AS p, unnest(embedding)::DOUBLE AS x FROM embeddings),
    m AS (SELECT label, p, round(avg(x), 9) AS m FROM v GROUP BY ALL)
    SELECT label, (p - 1)::INTEGER AS position, m AS mean FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY abs(m) DESC, p) AS r FROM m) WHERE r = 1
""")
def v03_dominant_dimension(spark, d):
    means = table(spark, d, "embeddings").select("label", F.posexplode("embedding").alias("p", "x")).groupBy("label", "p").agg(F.round(F.avg(F.col("x").cast("double")), 9).alias("m"))
    best = F.struct(F.abs("m"), -F.col("p"))
    return means.groupBy("label").agg(F.max_by("p", best).alias("position"), F.max_by("m", best).alias("mean"))


@query("""
    SELECT event_id, round(coalesce((0.6 * value + CASE WHEN user_id % 3 = 0 THEN 0 ELSE 0.25 * (user_id % 101) END + CASE WHEN user_id % 4 = 0 THEN 0 ELSE 0.15 * (event_id % 101) END)
        / (0.6 + CASE WHEN user_id % 3 = 0 THEN 0 ELSE 0.25 END + CASE WHEN user_id % 4 = 0 THEN 0 ELSE 0.15 END), 0), 6)::DOUBLE AS score FROM events WHERE value IS NOT NULL
""")
def f19_weighted_score(spark, d):
    parts = [(0.6, F.col("value")), (0.25, F.when(F.col("user_id") % 3 != 0, F.col("user_id") % 101)), (0.15, F.when(F.col("user_id") % 4 != 0, F.col("event_id") % 101))]
    total = sum((F.coalesce(w * x, F.lit(0.0)) for w, x in parts), F.lit(0.0))
    weight = sum((F.when(x.isNotNull(), w).otherwise(0.0) for w, x in parts), F.lit(0.0))
    return table(spark, d, "events").where("value is not null").select("event_id", F.round(total / weight, 6).alias("score"))


@query("""
    SELECT c.event_id AS click_id, v.event_id AS view_id FROM events c JOIN events v ON c.user_id = v.user_id AND date_trunc('hour', c.ts) = date_trunc('hour', v.ts) WHERE c.event_type = 'click' AND v.event_type = 'view'
""")
def j18_group_local_pairs(spark, d):
    side = lambda kind, name: table(spark, d, "events").where(F.col("event_type") == kind).select("user_id", F.date_trunc("hour", "ts").alias("hour"), F.col("event_id").alias(name))
    return side("click", "click_id").join(side("view", "view_id"), ["user_id", "hour"]).select("click_id", "view_id")


@query("""
    SELECT event_type, max(ts) AS high_water FROM events WHERE event_type <> 'error' OR event_id % 2 = 0 GROUP BY event_type
""")
def k04_watermarks(spark, d):
    mark = lambda rows: rows.groupBy("event_type").agg(F.max("ts").alias("high_water"))
    events = table(spark, d, "events")
    stored, arrived = mark(events.where("event_id % 2 = 0")), mark(events.where("event_id % 2 = 1 and event_type <> 'error'"))
    return stored.unionByName(arrived).groupBy("event_type").agg(F.max("high_water").alias("high_water"))


@query("""
    WITH t AS (SELECT user_id, event_type, epoch_us(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) - epoch_us(ts) AS us FROM events),
    s AS (SELECT user_id, event_type, sum(us) AS us FROM t WHERE us IS NOT NULL GROUP BY user_id, event_type)
    SELECT user_id, event_type, round(us / sum(us) OVER (PARTITION BY user_id), 9)::DOUBLE AS share FROM s
""")
def d12_time_shares(spark, d):
    until = F.timestamp_diff("MICROSECOND", F.col("ts"), F.lead("ts").over(Window.partitionBy(*USER).orderBy(*TIME)))
    spent = table(spark, d, "events").select("user_id", "event_type", until.alias("us")).where("us is not null").groupBy("user_id", "event_type").agg(F.sum("us").alias("us"))
    return spent.select("user_id", "event_type", F.round(F.try_divide(F.col("us"), F.sum("us").over(Window.partitionBy(*USER))), 9).alias("share"))


@query("""
    SELECT event_id, flip, CASE WHEN flip IN ('x', 'xy') THEN 105 - value ELSE value END AS x, CASE WHEN flip IN ('y', 'xy') THEN 68 - user_id % 68 ELSE user_id % 68 END AS y
    FROM events, (VALUES ('none'), ('x'), ('y'), ('xy')) f(flip)
""")
def d24_flips(spark, d):
    flips = F.explode(F.array(*(F.lit(f) for f in ("none", "x", "y", "xy"))))
    rows, y = table(spark, d, "events").select("event_id", "value", "user_id", flips.alias("flip")), F.col("user_id") % 68
    return rows.select("event_id", "flip", F.when(F.col("flip").isin("x", "xy"), 105 - F.col("value")).otherwise(F.col("value")).alias("x"), F.when(F.col("flip").isin("y", "xy"), 68 - y).otherwise(y).alias("y"))


@query("""
    SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS r FROM events WHERE value IS NOT NULL) WHERE r <= 3
""")
def l04_top_per_group(spark, d):
    ranked = table(spark, d, "events").where("value is not null").withColumn("r", F.row_number().over(Window.partitionBy(*USER).orderBy(F.col("value").desc(), "event_id")))
    return ranked.where("r <= 3").select("user_id", "event_id", "value")
