"""Registered queries that write tracking feeds from the events, read them back and give a row a player and frame."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from touchline.plans.base import query
from touchline.sources.shared import shared_path, table
from touchline.sources.tracking import wide_csv_tracking, xml_tracking


def _seen(spark, d):
    """The last place of each user in each hour; a day is a match, an hour of it a frame."""
    last = F.max_by(F.struct("value", "event_id"), F.struct("ts", "event_id"))
    own = table(spark, d, "events").where("value is not null").groupBy(F.to_date("ts").cast("string").alias("day"), F.hour("ts").alias("hour"), "user_id").agg(last.alias("p"))
    return own.select("day", "hour", "user_id", (F.col("p.value") / 120).cast("string").alias("x"), (F.col("p.event_id") % 80).cast("string").alias("y"))


def _written(rows, path):
    """A text file a day, its rows in the order of ``k``.

    The day can't be null, so that the writer has no reason to make another column of it and sort by that alone."""
    rows.select(F.coalesce("day", F.lit("none")).alias("day"), "k", "value").repartition("day").sortWithinPartitions("day", "k").select("day", "value").write.partitionBy("day").text(path)


SEEN = "s AS (SELECT strftime(ts::DATE, '%Y-%m-%d') AS day, hour(ts) AS hour, user_id, arg_max(value, (ts, event_id)) AS value, arg_max(event_id, (ts, event_id)) AS e FROM events WHERE value IS NOT NULL GROUP BY 1, 2, 3)"


@query(f"WITH {SEEN} SELECT day, 1 AS period, hour::BIGINT AS frame, hour * 0.5::DOUBLE AS seconds, CASE WHEN user_id % 2 = 0 THEN 'Home' ELSE 'Away' END AS team, user_id::VARCHAR AS number, 'Player' || user_id AS player, value / 120 AS x, (e % 80)::DOUBLE AS y FROM s")
def s03_wide_csv_tracking(spark, d):
    """A day's players are columns of its CSV file; the file is reshaped to a row a player and frame."""
    seen = _seen(spark, d)
    numbered = seen.select("day", "user_id").distinct().withColumn("i", F.row_number().over(Window.partitionBy("day").orderBy("user_id"))).select(F.col("day").alias("of"), F.col("user_id").alias("player"), "i")
    # A line's cells carry the gaps before them, so that nothing is looked up once a player and frame.
    gap = lambda n: F.repeat(F.lit(",NaN,NaN"), n.cast("int"))
    before = F.lag("i", 1, 0).over(Window.partitionBy("day", "hour").orderBy("i"))
    cells = seen.join(numbered, (F.col("day") == F.col("of")) & F.col("user_id").eqNullSafe(F.col("player"))).select("day", "hour", "i", F.concat(gap(F.col("i") - before - 1), F.lit(","), "x", F.lit(","), "y").alias("text"))
    joined = lambda c, by: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(by, c))), lambda s: s["text"]), "")
    lines = cells.groupBy("day", "hour").agg(joined("text", "i").alias("cells"), F.max("i").alias("last"))
    number = F.coalesce(F.col("player").cast("string"), F.lit(""))
    name = F.when(F.col("player").isNull(), "").otherwise(F.concat(F.lit("Player"), number))
    heads = numbered.groupBy(F.col("of").alias("day")).agg(F.max("i").alias("n"), *(joined(F.concat(F.lit(","), v, F.lit(",")).alias("text"), "i").alias(k) for k, v in (("teams", F.when(F.col("player") % 2 == 0, "Home").otherwise("Away")), ("numbers", number), ("names", name))))
    body = lines.join(heads.select("day", "n"), "day").select("day", (F.col("hour") + 3).alias("k"), F.concat(F.lit("1,"), F.col("hour").cast("string"), F.lit(","), (F.col("hour") * 0.5).cast("string"), "cells", gap(F.col("n") - F.col("last"))).alias("value"))
    # The header's three lines are one row: no sort can part them.
    heads = heads.select("day", F.lit(0).alias("k"), F.concat(F.lit(",,"), "teams", F.lit("\n,,"), "numbers", F.lit("\nPeriod,Frame,Time [s]"), "names").alias("value"))
    path = shared_path(spark, "wide-csv")
    _written(heads.unionByName(body), path)
    out = wide_csv_tracking(spark, path)
    return out.select(F.regexp_extract("file", "day=([0-9-]+)", 1).alias("day"), "period", "frame", "seconds", "team", "number", "player", "x", "y")


@query(f"WITH {SEEN} SELECT day, 'firstHalf' AS section, 'M' || day AS match, CASE WHEN user_id % 2 = 0 THEN 'Home' ELSE 'Away' END AS team, 'P' || user_id AS player, hour::BIGINT AS frame, day || 'T' || lpad(hour::VARCHAR, 2, '0') AS time, value / 120 AS x, (e % 80)::DOUBLE AS y FROM s")
def s04_xml_tracking(spark, d):
    """A day's XML file has a frame set for each player."""
    seen = _seen(spark, d)
    frame = F.format_string('<Frame N="%s" T="%sT%02d" X="%s" Y="%s" />', F.col("hour").cast("string"), "day", "hour", "x", "y")
    sets = seen.groupBy("day", "user_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("hour", frame.alias("f")))), lambda s: s["f"]), "\n").alias("frames"))
    value = F.concat(F.format_string('<FrameSet GameSection="firstHalf" MatchId="M%s" TeamId="%s" PersonId="P%s">\n', "day", F.when(F.col("user_id") % 2 == 0, "Home").otherwise("Away"), F.col("user_id").cast("string")), F.col("frames"), F.lit("\n</FrameSet>"))
    path = shared_path(spark, "xml-tracking")
    ends = seen.select("day").distinct().select("day", F.explode(F.array(F.struct(F.lit(-1).cast("long").alias("k"), F.lit('<?xml version="1.0"?>\n<Positions>').alias("value")), F.struct(F.lit(2**62).alias("k"), F.lit("</Positions>").alias("value")))).alias("e")).select("day", "e.*")
    _written(ends.unionByName(sets.select("day", F.col("user_id").alias("k"), value.alias("value"))), path)
    out = xml_tracking(spark, path)
    return out.select(F.regexp_extract("file", "day=([0-9-]+)", 1).alias("day"), "section", "match", "team", "player", "frame", "time", "x", "y")
