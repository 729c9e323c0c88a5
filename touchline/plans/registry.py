"""The registered queries over the reference's own operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from touchline.operators.monitors import percentiles
from touchline.operators.tables import full_outer, surrogate_key, upsert
from touchline.operators.temporal import asof_join, band_join, latest_state, sessions
from touchline.operators.vectors import mean_vector, nearest
from touchline.plans import calibrating, entities, feeds, kernels, marts, ordered, relational, sinks, staging, trackers  # noqa: F401  (register their queries)
from touchline.plans.base import QUERIES, SQL, query  # noqa: F401
from touchline.sources.shared import table
from touchline.streaming.windows import hourly_counts


def _events(spark, d, kind=None):
    rows = table(spark, d, "events")
    return rows if kind is None else rows.where(F.col("event_type") == kind)


@query("""
    WITH s AS (SELECT event_id, user_id, event_type,
        last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER w AS last_purchase,
        count(CASE WHEN event_type = 'purchase' THEN 1 END) OVER w AS earlier_purchases
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT *, CASE WHEN last_purchase IS NULL THEN 'new' WHEN last_purchase >= 50 THEN 'high' ELSE 'low' END AS state FROM s
""")
def j03_asof_latest_state(spark, d):
    bought = F.when(F.col("event_type") == "purchase", F.col("value"))
    rows = latest_state(_events(spark, d), ["user_id"], ["ts", "event_id"], {"last_purchase": bought})
    before = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    state = F.when(F.col("last_purchase").isNull(), "new").when(F.col("last_purchase") >= 50, "high").otherwise("low")
    return rows.select("event_id", "user_id", "event_type", "last_purchase", F.count(bought).over(before).alias("earlier_purchases"), state.alias("state"))


@query("""
    WITH p AS (SELECT c.event_id, v.event_id AS view_id, row_number() OVER (PARTITION BY c.event_id ORDER BY v.ts DESC, v.event_id DESC) AS r
        FROM events c LEFT JOIN events v ON v.event_type = 'view' AND v.user_id = c.user_id AND v.ts <= c.ts AND v.ts >= c.ts - INTERVAL 1 HOUR WHERE c.event_type = 'click')
    SELECT event_id, view_id FROM p WHERE r = 1
""")
def j04_asof_tolerance(spark, d):
    joined = asof_join(_events(spark, d, "click").select("user_id", "ts", "event_id"), _events(spark, d, "view"), ["user_id"], "ts", "event_id", ["event_id"], F.col("right_ts") >= F.col("ts") - F.expr("INTERVAL 1 HOUR"))
    return joined.select("event_id", F.col("right_event_id").alias("view_id"))


@query("""
    SELECT c.event_id AS click_id, e.event_id AS error_id FROM events c JOIN events e ON c.user_id = e.user_id AND e.ts BETWEEN c.ts - INTERVAL 10 MINUTE AND c.ts + INTERVAL 10 MINUTE
    WHERE c.event_type = 'click' AND e.event_type = 'error'
""")
def j06_band_join(spark, d):
    clicks = _events(spark, d, "click").select("user_id", F.col("ts").alias("click_ts"), F.col("event_id").alias("click_id"))
    errors = _events(spark, d, "error").select("user_id", F.col("ts").alias("error_ts"), F.col("event_id").alias("error_id"))
    return band_join(clicks, errors, ["user_id"], "click_ts", "error_ts", 600, 600).select("click_id", "error_id")


@query("""
    SELECT purchase_id, view_id FROM (SELECT p.event_id AS purchase_id, v.event_id AS view_id, row_number() OVER (PARTITION BY p.event_id ORDER BY abs(epoch_us(v.ts) - epoch_us(p.ts)), v.event_id) AS r
    FROM events p JOIN events v ON p.user_id = v.user_id AND v.ts BETWEEN p.ts - INTERVAL 2 HOUR AND p.ts + INTERVAL 5 HOUR WHERE p.event_type = 'purchase' AND v.event_type = 'view') WHERE r = 1
""")
def j08_nearest_in_window(spark, d):
    left = _events(spark, d, "purchase").select("user_id", F.col("ts").alias("p_ts"), F.col("event_id").alias("purchase_id"))
    right = _events(spark, d, "view").select("user_id", F.col("ts").alias("v_ts"), F.col("event_id").alias("view_id"))
    pairs = band_join(left, right, ["user_id"], "p_ts", "v_ts", 7200, 18000)
    return pairs.groupBy("purchase_id").agg(F.min_by("view_id", F.struct(F.abs(F.round("gap", 6)), "view_id")).alias("view_id"))


@query("""
    WITH p AS (SELECT nullif(user_id % 7, 0) AS k, count(*) AS purchases FROM events WHERE event_type = 'purchase' AND user_id % 7 <> 3 GROUP BY 1),
    e AS (SELECT nullif(user_id % 7, 0) AS k, count(*) AS errors FROM events WHERE event_type = 'error' AND user_id % 7 <> 5 GROUP BY 1)
    SELECT coalesce(p.k, e.k) AS k, p.purchases, e.errors FROM p FULL JOIN e ON p.k IS NOT DISTINCT FROM e.k
""")
def j10_null_tolerant_full_outer(spark, d):
    key = F.nullif(F.col("user_id") % 7, F.lit(0).cast("long")).alias("k")
    side = lambda kind, gone, name: _events(spark, d, kind).where(F.col("user_id") % 7 != gone).groupBy(key).agg(F.count(F.lit(1)).alias(name))
    return full_outer(side("purchase", 3, "purchases"), side("error", 5, "errors"), ["k"])


@query("""SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""")
def j11_new_id_discovery(spark, d):
    return table(spark, d, "customer").join(table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("""
    WITH n AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) > 6 * 3600 * 1000000::BIGINT THEN 1 ELSE 0 END AS b FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    s AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts, event_id)::BIGINT AS session_no FROM n)
    SELECT user_id, session_no, count(*) AS n_events, min(event_id) AS first_event FROM s GROUP BY 1, 2
""")
def w07_gap_sessions(spark, d):
    return sessions(_events(spark, d), ["user_id"], "ts", "event_id", 6 * 3600).groupBy("user_id", "session_no").agg(F.count(F.lit(1)).alias("n_events"), F.min("event_id").alias("first_event"))


@query("""
    WITH t AS (SELECT event_type AS a, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events)
    SELECT a AS from_type, b AS to_type, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY a), 9)::DOUBLE AS share FROM t WHERE b IS NOT NULL GROUP BY a, b
""")
def d30_transition_grid(spark, d):
    follows = F.lead("event_type").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    n = _events(spark, d).select(F.col("event_type").alias("from_type"), follows.alias("to_type")).where("to_type is not null").groupBy("from_type", "to_type").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("from_type")), 9))


@query("""
    SELECT o_orderkey, o_custkey, row_number() OVER w AS nth, count(*) OVER w AS orders_so_far, max(o_totalprice) OVER w AS highest_so_far FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
""")
def w02_cumulative(spark, d):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", F.row_number().over(w).cast("long").alias("nth"), F.count(F.lit(1)).over(w).alias("orders_so_far"), F.max("o_totalprice").over(w).alias("highest_so_far"))


@query("""SELECT event_type, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.9), 6) AS p90, count(*) AS n FROM events GROUP BY 1""")
def a05_percentiles(spark, d):
    out = percentiles(_events(spark, d), ["event_type"], "value", {"p50": 0.5, "p90": 0.9}, width=5)
    return out.select("event_type", F.round("p50", 6).alias("p50"), F.round("p90", 6).alias("p90"), "n")


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""")
def a25_rollup(spark, d):
    return table(spark, d, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))


@query("""
    SELECT event_type, sum((props->>'k')::BIGINT)::BIGINT AS k_sum, count(DISTINCT user_id) AS users FROM events GROUP BY 1
""")
def f14_json_paths(spark, d):
    return _events(spark, d).groupBy("event_type").agg(F.sum(F.get_json_object("props", "$.k").try_cast("long")).alias("k_sum"), F.countDistinct("user_id").alias("users"))


@query("""
    SELECT md5(concat_ws('-', coalesce(l_orderkey::VARCHAR, '_dbt_utils_surrogate_key_null_'), coalesce(l_linenumber::VARCHAR, '_dbt_utils_surrogate_key_null_'), coalesce(nullif(l_returnflag, 'N'), '_dbt_utils_surrogate_key_null_'))) AS row_key,
        CASE WHEN l_discount > 0.06 THEN 'deep' WHEN l_discount < 0.02 THEN 'none' ELSE 'some' END AS discount_class FROM lineitem
""")
def p03_surrogate_key_and_ladder(spark, d):
    rows = table(spark, d, "lineitem").withColumn("flag", F.nullif(F.col("l_returnflag"), F.lit("N")))
    return rows.select(surrogate_key("l_orderkey", "l_linenumber", "flag").alias("row_key"), F.when(F.col("l_discount") > 0.06, "deep").when(F.col("l_discount") < 0.02, "none").otherwise("some").alias("discount_class"))


@query("""
    SELECT o_orderkey, 'closed' AS status FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT o_orderkey + 1000000000, 'closed' FROM orders WHERE o_orderkey % 6 = 0
    UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 3 <> 0
""")
def k02_upsert(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    closed = F.lit("closed").alias("status")
    changed = orders.where("o_orderkey % 3 = 0").select("o_orderkey", closed)
    added = orders.where("o_orderkey % 6 = 0").select((F.col("o_orderkey") + 1_000_000_000).alias("o_orderkey"), closed)
    return upsert(orders, changed.unionByName(added), ["o_orderkey"])


@query("""
    SELECT label, (p - 1)::INTEGER AS position, round(avg(x::DOUBLE), 6) AS mean FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS p FROM embeddings) GROUP BY 1, 2
""")
def v01_mean_vectors(spark, d):
    rows = table(spark, d, "embeddings").select("label", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    return mean_vector(rows, "label", "v").select("label", "position", F.round("mean", 6).alias("mean"))


@query("""
    SELECT query_id, neighbour_id, rank FROM (SELECT q.vec_id AS query_id, r.vec_id AS neighbour_id, row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_cosine_similarity(q.embedding::DOUBLE[], r.embedding::DOUBLE[]), 9) DESC, r.vec_id)::INTEGER AS rank
    FROM embeddings q JOIN embeddings r ON q.vec_id <> r.vec_id WHERE q.vec_id % 50 = 0) WHERE rank <= 5
""")
def v02_nearest_vectors(spark, d):
    rows = table(spark, d, "embeddings")
    return nearest(rows, rows.where("vec_id % 50 = 0"), "vec_id", "embedding", 5)


@query("""SELECT date_trunc('hour', ts)::TIMESTAMP AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def s01_tumbling_windows(spark, d):
    return hourly_counts(_events(spark, d))
