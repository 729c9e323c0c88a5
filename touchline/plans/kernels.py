"""Registered queries over frames of players: lines, shape graphs, formations, off-ball value and the timing of passes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from touchline.operators import offball, shapes, threat
from touchline.operators.augmentation import augmented
from touchline.operators.kinematics import control_surface
from touchline.plans.base import query
from touchline.sources.shared import table


def places(spark, d):
    """Events as places in a 120 x 80 pitch; a user plays for the side of its number, an hour is a frame."""
    x, y = F.col("value") * 1.2, ((F.col("event_id") * 7919) % 800) / 10
    return table(spark, d, "events").select("event_id", "ts", "user_id", "value", F.col("user_id").bitwiseAND(1).cast("int").alias("side"), F.date_trunc("hour", "ts").alias("frame"), x.alias("x"), y.alias("y"))


def _frames(spark, d):
    return shapes.frames(places(spark, d), ["frame", "side"], "user_id", ["ts", "event_id"], most=10)


@query(None)
def d05_line_breaking(spark, d):
    """Moves of users from one event to their next, against the other side's ten players of the hour."""
    after = Window.partitionBy("user_id").orderBy("ts", "event_id")
    moves = places(spark, d).withColumn("end_x", F.lead("x").over(after)).withColumn("end_y", F.lead("y").over(after)).withColumn("side", 1 - F.col("side"))
    return shapes.line_breaking(moves, _frames(spark, d), ["frame", "side"], "event_id")


@query(None)
def d11_shape_graph(spark, d):
    """Stable edges between a side's players of each hour."""
    return shapes.shape_graphs(_frames(spark, d), ["frame", "side"]).withColumn("stability", F.round("stability", 6))


@query(None)
def d10_formations(spark, d):
    """Formations of each side in windows of twelve hours, and the role of each player."""
    found = shapes.formations(places(spark, d), ["side"], "user_id", F.unix_timestamp("ts"), window=43200.0)
    return found.withColumn("cost", F.round("cost", 6))


COLUMNS, ROWS = 21, 14


@query(f"""
    WITH p AS (SELECT date_trunc('hour', ts) AS frame, event_type = 'click' OR event_type = 'view' AS home, value AS x, user_id % 68 AS y, (value % 7) - 3 AS vx, (user_id % 5) - 2 AS vy FROM events WHERE value IS NOT NULL),
    g AS (SELECT c AS cell, (c % {COLUMNS}) * (105.0::DOUBLE / {COLUMNS - 1}) AS gx, (c // {COLUMNS}) * (68.0::DOUBLE / {ROWS - 1}) AS gy FROM range({COLUMNS * ROWS}) r(c)),
    e AS (SELECT frame, cell, home, vx, vy, gx - x AS dx, gy - y AS dy, sqrt((gx - x) ** 2 + (gy - y) ** 2) AS d FROM p, g),
    t AS (SELECT frame, cell, home, greatest(0.7, 0.7 + (sqrt(v * v + 14 * d) - v) / 7) AS t FROM (SELECT *, CASE WHEN d > 0 THEN (vx * dx + vy * dy) / d ELSE 0 END AS v FROM e)),
    m AS (SELECT frame, cell, min(t) FILTER (WHERE home) AS h, min(t) FILTER (WHERE NOT home) AS w FROM t GROUP BY ALL),
    i AS (SELECT frame, cell, any_value(h) AS h, any_value(w) AS w, sum(CASE WHEN home THEN v END) AS hi, sum(CASE WHEN NOT home THEN v END) AS wi
        FROM (SELECT frame, cell, home, h, w, 1 / (1 + exp(greatest(-50, least(50, (t - CASE WHEN home THEN w ELSE h END) * pi() / sqrt(3.0) / 0.45)))) AS v FROM t JOIN m USING (frame, cell)) GROUP BY ALL),
    c AS (SELECT frame, cell, gx * 120 / 105 AS x, gy * 80 / 68 AS y, CASE WHEN w IS NULL THEN 1 WHEN h IS NULL THEN 0 WHEN hi + wi > 1e-10 THEN hi / (hi + wi) ELSE 0.5 END AS control FROM i JOIN g USING (cell)),
    b AS (SELECT date_trunc('hour', ts) AS frame, arg_max(value, ts) * 120 / 105 AS bx, (arg_max(user_id, ts) % 68) * 80 / 68.0::DOUBLE AS qy FROM events WHERE value IS NOT NULL GROUP BY 1),
    r AS (SELECT frame, cell, control, x / 120 AS u, exp(-((x / 120 - 0.5) ** 2 + (y / 80 - 0.5) ** 2) / 0.18::DOUBLE) * exp(-((x - bx) ** 2) / 1800 - (y - qy) ** 2 / 800) AS t FROM c JOIN b USING (frame)),
    o AS (SELECT frame, cell, greatest(0, least(1, control * CASE WHEN max(t) OVER (PARTITION BY frame) > 1e-10 THEN t / max(t) OVER (PARTITION BY frame) ELSE t END * (0.01 + 0.29 * u))) AS v FROM r)
    SELECT frame, count(*) AS cells, round(max(v), 6)::DOUBLE AS best, round(avg(v), 6)::DOUBLE AS mean FROM o GROUP BY frame
""")
def d07_off_ball_value(spark, d):
    """The home side's best and mean off-ball value of each hour; the ball is where the hour's last event was."""
    rows = table(spark, d, "events").where("value is not null").select(F.date_trunc("hour", "ts").alias("frame"), "ts", "event_type", F.col("value").alias("x"), (F.col("user_id") % 68).alias("y"), (F.col("value") % 7 - 3).alias("vx"), (F.col("user_id") % 5 - 2).alias("vy"))
    control = control_surface(rows.drop("ts"), ["frame"], F.col("event_type").isin("click", "view"), columns=COLUMNS, rows=ROWS)
    ball = rows.groupBy("frame").agg((F.max_by("x", "ts") * 120 / 105).alias("ball_x"), (F.max_by("y", "ts") * 80 / 68).alias("ball_y"))
    x, y = (F.col("cell") % COLUMNS) * (120.0 / (COLUMNS - 1)), F.floor(F.col("cell") / COLUMNS) * (80.0 / (ROWS - 1))
    cells = control.join(ball, "frame").select("frame", F.col("home_control").alias("control"), x.alias("x"), y.alias("y"), "ball_x", "ball_y")
    return offball.off_ball_value(cells, ["frame"]).groupBy("frame").agg(F.count(F.lit(1)).alias("cells"), F.round(F.max("off_ball_value"), 6).alias("best"), F.round(F.avg("off_ball_value"), 6).alias("mean"))


@query("""
    WITH e AS (SELECT event_id, ts, user_id, (user_id & 1)::INTEGER AS side, date_trunc('hour', ts) AS frame, value * 1.2 AS x, ((event_id * 7919) % 800) / 10 AS y, (value % 7) - 3 AS vx, ((user_id % 5) - 2)::DOUBLE AS vy FROM events),
    p AS (SELECT event_id, frame, user_id, side, lead(x) OVER w AS ex, lead(y) OVER w AS ey FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    l AS (SELECT frame, side, user_id, x, y, vx, vy FROM (SELECT *, row_number() OVER (PARTITION BY frame, side ORDER BY ts DESC, event_id DESC, user_id) AS k
        FROM (SELECT *, row_number() OVER (PARTITION BY frame, user_id ORDER BY ts DESC, event_id DESC) AS j FROM e WHERE x IS NOT NULL) WHERE j = 1) WHERE k <= 11),
    q AS (SELECT event_id, frame, side, user_id, ex AS tx, ey AS ty, dt, true AS target FROM p, (SELECT unnest([-3, -2, -1, 0, 1]) AS dt) WHERE ex IS NOT NULL
        UNION ALL SELECT p.event_id, p.frame, p.side, p.user_id, l.x, l.y, 0, false FROM p JOIN l ON p.frame = l.frame AND p.side = l.side AND p.user_id <> l.user_id WHERE p.ex IS NOT NULL),
    a AS (SELECT q.event_id, q.side, tx, ty, dt, target, l.side = 0 AS home, greatest(0, least(120, l.x + l.vx * dt)) * 0.875 AS px, greatest(0, least(80, l.y + l.vy * dt)) * 0.85 AS py, l.vx * 0.875 AS vx, l.vy * 0.85 AS vy FROM q JOIN l ON q.frame = l.frame),
    b AS (SELECT *, sqrt((tx * 0.875 - px) ** 2 + (ty * 0.85 - py) ** 2) AS dist FROM a),
    t AS (SELECT event_id, side, tx, ty, dt, target, home, greatest(0.7, 0.7 + (sqrt(v * v + 14 * dist) - v) / 7) AS t FROM (SELECT *, CASE WHEN dist > 0 THEN (vx * (tx * 0.875 - px) + vy * (ty * 0.85 - py)) / dist ELSE 0 END AS v FROM b)),
    m AS (SELECT *, min(CASE WHEN home THEN t END) OVER g AS mh, min(CASE WHEN NOT home THEN t END) OVER g AS ma FROM t WINDOW g AS (PARTITION BY event_id, tx, ty, dt, target)),
    s AS (SELECT event_id, side, tx, ty, dt, target, any_value(mh) AS mh, any_value(ma) AS ma, sum(CASE WHEN home THEN i ELSE 0 END) AS h, sum(CASE WHEN home THEN 0 ELSE i END) AS w FROM
        (SELECT *, 1 / (1 + exp(greatest(-50, least(50, -((CASE WHEN home THEN ma ELSE mh END) - t) * pi() / (sqrt(3.0) * 0.45))))) AS i FROM m) GROUP BY ALL),
    c AS (SELECT *, CASE WHEN mh IS NULL THEN 0 WHEN ma IS NULL THEN 1 WHEN h + w > 1e-10 THEN h / (h + w) ELSE 0.5 END AS share, floor(greatest(0, least(103, tx / 120 * 103))) / 103 AS u, floor(greatest(0, least(67, ty / 80 * 67))) / 67 AS v FROM s),
    o AS (SELECT event_id, dt, target, greatest(0, least(1, CASE WHEN side = 0 THEN share ELSE 1 - share END * exp(-((u - 0.5) ** 2 + (v - 0.5) ** 2) / 0.18::DOUBLE) * (0.01 + 0.29 * u))) AS worth FROM c),
    r AS (SELECT event_id, max(CASE WHEN target AND dt = 0 THEN worth END) AS actual, max(CASE WHEN target THEN worth END) AS peak, max(CASE WHEN dt = 0 THEN worth END) AS optimal FROM o GROUP BY 1)
    SELECT p.event_id, round(actual, 6)::DOUBLE AS actual, round(peak, 6)::DOUBLE AS peak, round(optimal, 6)::DOUBLE AS optimal, round(CASE WHEN peak > 0 THEN actual / peak * CASE WHEN optimal > 0 THEN actual / optimal ELSE 0 END ELSE actual * 0 END, 6)::DOUBLE AS score FROM p LEFT JOIN r ON p.event_id = r.event_id
""")
def d08_pass_timing(spark, d):
    """Each move's value at its target against the best moment around it and the best mate."""
    rows = places(spark, d).withColumns({"vx": F.col("value") % 7 - 3, "vy": (F.col("user_id") % 5 - 2).cast("double")})
    after = Window.partitionBy("user_id").orderBy("ts", "event_id")
    moves = rows.select("event_id", "frame", "user_id", "side", (F.col("side") == 0).alias("home"), F.lead("x").over(after).alias("end_x"), F.lead("y").over(after).alias("end_y"))
    last = rows.where("x is not null").groupBy("frame", "side", "user_id").agg(F.max(F.struct("ts", "event_id", F.struct((F.col("side") == 0).alias("home"), "x", "y", "vx", "vy", "user_id", "side").alias("p"))).alias("s"))
    seen = last.withColumn("k", F.row_number().over(Window.partitionBy("frame", "side").orderBy(F.col("s.ts").desc(), F.col("s.event_id").desc(), "user_id"))).where("k <= 11")
    teams = seen.groupBy("frame").agg(F.collect_list("s.p").alias("players"))  # eleven a side
    mates = F.filter("players", lambda p: (p["side"] == F.col("side")) & (p["user_id"] != F.col("user_id")))
    found = offball.pass_values(moves.join(teams, "frame").withColumn("mates", mates), "event_id")
    return found.select("event_id", *(F.round(c, 6).alias(c) for c in ("actual", "peak", "optimal", "score")))


@query(None)
def d09_team_shape(spark, d):
    """Centre, spread, hull and lines of each side in each hour."""
    out = shapes.team_shapes(_frames(spark, d), ["frame", "side"])
    return out.select("frame", "side", "players", *(F.round(c, 6).alias(c) for c in ("centre_x", "centre_y", "length", "width", "stretch", "hull_area", "line_height")), F.transform("line_gaps", lambda g: F.round(g, 6)).alias("line_gaps"))


def actions(spark, d):
    """Events as actions in metres: purchases are shots, clicks and views moves to the user's next place; the numbers decide on success."""
    after = Window.partitionBy("user_id").orderBy("ts", "event_id")
    x, y = F.col("value") * 1.05, ((F.col("event_id") * 7919) % 680) / 10
    rows = table(spark, d, "events").select("event_id", "user_id", F.date_trunc("hour", "ts").alias("frame"), "event_type", "value", x.alias("x"), y.alias("y"), F.lead(x).over(after).alias("end_x"), F.lead(y).over(after).alias("end_y"))
    return rows.withColumns({"league": F.col("user_id").bitwiseAND(3).cast("int"), "is_shot": F.col("event_type") == "purchase", "is_move": F.col("event_type").isin("click", "view"), "success": F.col("event_id") % 3 > 0})


ACTIONS = """
    a AS (SELECT event_id, user_id, (user_id & 3)::INTEGER AS league, date_trunc('hour', ts) AS frame, event_type, value, value * 1.05 AS x, ((event_id * 7919) % 680) / 10 AS y, lead(value * 1.05) OVER w AS ex, lead(((event_id * 7919) % 680) / 10) OVER w AS ey, event_id % 3 > 0 AS ok
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
"""
ZONE = "(11 - least(greatest(trunc({y} / (68.0::DOUBLE / 12))::INTEGER, 0), 11)) * 16 + least(greatest(trunc({x} / (105.0::DOUBLE / 16))::INTEGER, 0), 15)"


@query(f"""
    WITH {ACTIONS}, z AS (SELECT league, {ZONE.format(x="x", y="y")} AS zone, event_type = 'purchase' AS shot, ex IS NOT NULL AND ey IS NOT NULL AS ended, ok FROM a WHERE x IS NOT NULL AND y IS NOT NULL AND event_type IN ('purchase', 'click', 'view'))
    SELECT league, zone::INTEGER AS zone, count(*) FILTER (shot) AS shots, count(*) FILTER (shot AND ok) AS goals, count(*) FILTER (NOT shot) AS moves, count(*) FILTER (NOT shot AND ended) AS starts FROM z GROUP BY 1, 2
""")
def a15_pitch_zones(spark, d):
    """Shots, goals and moves of each league in the 192 zones of the pitch."""
    return threat.zone_counts(actions(spark, d), ["league"])[0]


@query(f"""
    WITH {ACTIONS} SELECT league, ({ZONE.format(x="x", y="y")})::INTEGER AS zone, ({ZONE.format(x="ex", y="ey")})::INTEGER AS to_zone, count(*) AS n FROM a
    WHERE x IS NOT NULL AND y IS NOT NULL AND ex IS NOT NULL AND ey IS NOT NULL AND ok AND event_type IN ('click', 'view') GROUP BY ALL
""")
def a15_zone_transitions(spark, d):
    """Successful moves of each league from zone to zone."""
    return threat.zone_counts(actions(spark, d), ["league"])[1]


@query(None)
def d03_zone_values(spark, d):
    """Expected threat of the 192 zones in each league, repeated until settled."""
    return threat.expected_threat(actions(spark, d), ["league"]).withColumn("value", F.round("value", 6))


CREDIT = """CASE WHEN k AND user_id = defender THEN 'intercept' WHEN value > 0 AND nearest = 1 THEN 'concede' WHEN distance <= 5 THEN 'disturb'
    WHEN value < 0 AND sqrt((105 - ax) ** 2 + (34 - ay) ** 2) >= 1e-9 AND distance >= 1e-9 AND degrees(acos(greatest(-1, least(1, ((105 - ax) * (x - ax) + (34 - ay) * (y - ay)) / (sqrt((105 - ax) ** 2 + (34 - ay) ** 2) * distance))))) <= 15 THEN 'deter' END"""


@query(f"""
    WITH {ACTIONS}, e AS (SELECT event_id, user_id, frame, x AS ax, y AS ay, round(value - 50, 2) AS value, event_type = 'error' AS k FROM a WHERE x IS NOT NULL),
    f AS (SELECT frame, defender, x, y FROM (SELECT *, row_number() OVER (PARTITION BY frame ORDER BY last DESC, defender) AS r FROM (SELECT date_trunc('hour', ts) AS frame, user_id AS defender, max((ts, event_id)) AS last, arg_max(value * 1.05, (ts, event_id)) AS x, arg_max(((event_id * 7919) % 680) / 10, (ts, event_id)) AS y FROM events WHERE value IS NOT NULL GROUP BY 1, 2)) WHERE r <= 11),
    d AS (SELECT e.*, f.defender, f.x, f.y, sqrt((f.x - ax) ** 2 + (f.y - ay) ** 2) AS distance FROM e JOIN f ON e.frame = f.frame),
    n AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY k AND user_id = defender, distance, defender) AS nearest FROM d),
    c AS (SELECT event_id, defender, {CREDIT} AS credit, round(distance, 6) AS distance FROM n)
    SELECT * FROM c WHERE credit IS NOT NULL
""")
def d06_defensive_credits(spark, d):
    """Credits of the eleven users last seen in an hour for the actions of that hour; errors stand for tackles."""
    rows = actions(spark, d).where("x is not null")
    acts = rows.select("event_id", F.col("user_id").alias("actor"), "frame", F.when(F.col("event_type") == "error", "tackle").otherwise("pass").alias("action_type"), F.col("x").alias("action_x"), F.col("y").alias("action_y"), F.round(F.col("value") - 50, 2).alias("value"))
    spots = table(spark, d, "events").select("ts", "event_id", "user_id", F.date_trunc("hour", "ts").alias("frame"), (F.col("value") * 1.05).alias("x"), (((F.col("event_id") * 7919) % 680) / 10).alias("y"))
    teams = shapes.frames(spots, ["frame"], "user_id", ["ts", "event_id"], most=11)
    each = teams.select("frame", F.explode(F.arrays_zip("players", "xs", "ys")).alias("p")).select("frame", F.col("p.players").alias("defender"), F.col("p.xs").alias("x"), F.col("p.ys").alias("y"))
    return threat.defensive_credits(acts.join(each, "frame"), "event_id", "defender").withColumn("distance", F.round("distance", 6))


SHIFT = "least({most}, greatest(0, {v} + 0.5 * (('0x' || substr(md5(event_id || '|1|{v}'), 1, 8))::BIGINT / 2147483648::DOUBLE - 1)))"


@query(f"""
    WITH e AS (SELECT event_id, (user_id & 1)::INTEGER AS side, value * 1.2 AS x, ((event_id * 7919) % 800) / 10 AS y FROM events WHERE value IS NOT NULL),
    v AS (SELECT event_id, 'as_is' AS variant, x, y, side FROM e UNION ALL SELECT event_id, 'mirrored', x, 80 - y, side FROM e UNION ALL SELECT event_id, 'swapped', 120 - x, 80 - y, 1 - side FROM e
        UNION ALL SELECT event_id, 'shifted', {SHIFT.format(v="x", most=120)}, {SHIFT.format(v="y", most=80)}, side FROM e)
    SELECT event_id, variant, round(x, 6)::DOUBLE AS x, round(y, 6)::DOUBLE AS y, side::INTEGER AS side FROM v
""")
def d24_augmented(spark, d):
    """Each event as it is, mirrored, with sides swapped, and shifted a little."""
    rows = places(spark, d).where("x is not null").select("event_id", "x", "y", "side")
    return augmented(rows, "event_id", "side").select("event_id", "variant", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), "side")


@query("""
    SELECT 'one kind' AS asked, event_id FROM events WHERE event_type = 'purchase' UNION ALL SELECT 'kind and value', event_id FROM events WHERE event_type = 'click' AND value >= 50
    UNION ALL SELECT 'everything', event_id FROM events UNION ALL SELECT 'no match', event_id FROM events WHERE event_type = 'x'' OR 1 = 1 --'
""")
def p09_optional_clauses(spark, d):
    """One statement with named parameters, of which any may be left out; values are never part of the statement's text."""
    asked = {"one kind": ("purchase", None), "kind and value": ("click", 50.0), "everything": (None, None), "no match": ("x' OR 1 = 1 --", None)}
    out = None
    for name, (kind, least) in asked.items():
        text = "SELECT :name AS asked, event_id FROM {events} WHERE (:kind IS NULL OR event_type = :kind) AND (:least IS NULL OR value >= :least)"
        own = spark.sql(text, args={"name": name, "kind": kind, "least": least}, events=table(spark, d, "events"))
        out = own if out is None else out.unionByName(own)
    return out
