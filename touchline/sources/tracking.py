"""Tracking feeds, one row a player and frame: wide CSV with three header lines, and XML frame sets.

Spark's text reader cuts files into byte ranges at the ends of lines or before any other text that begins a record, so a large file is
read by many tasks and no frame is lost or read twice. What a frame needs from outside of its range comes by a small table: the header
of its file, or the frame set that a range begins in."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Header lines of a wide tracking CSV, and columns before the players' (fixed values).
HEADERS, LEADING = 3, 3
#: Begins a frame of an XML tracking feed, and what a frame set says of its frames (fixed values).
FRAME, SET = "<Frame ", ["GameSection", "MatchId", "TeamId", "PersonId"]


def _number(text: Column, kind: str) -> Column:
    """Null for missing values (empty, NaN); other text that is no number is an error."""
    known = F.when(~F.lower(F.trim(text)).isin("", "nan"), F.trim(text))
    wrong = F.raise_error(F.concat(F.lit(f"not a {kind}: "), text)).cast(kind)
    return F.when(known.isNull() | known.try_cast(kind).isNotNull(), known.try_cast(kind)).otherwise(wrong)


def wide_csv_tracking(spark: SparkSession, path: str) -> DataFrame:
    """``file, period, frame, seconds, team, number, player, x, y`` of CSV files with a pair of columns for each player and the ball.

    The three header lines name teams, numbers, and columns: ``Period, Frame, Time [s]``, then a name over the first column of each
    pair. Places that are missing have no row. A file's lines may be read by many tasks; its headers are joined to them."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    parts = lines.where(F.trim("value") != "").withColumn("c", F.split("value", ","))
    is_body = F.get("c", F.lit(0)).rlike(r"^\s*\d+\s*$") & F.get("c", F.lit(1)).rlike(r"^\s*\d+\s*$")
    heads = parts.where(~is_body).groupBy("file").agg(F.transform(F.array_sort(F.collect_list(F.struct("block", "at", "c"))), lambda h: h["c"]).alias("h"))
    heads = heads.where(F.when(F.size("h") == HEADERS, True).otherwise(F.raise_error(F.concat(F.lit("not three header lines in "), F.col("file"))).cast("boolean")))
    heads = heads.select(F.col("file").alias("of"), F.element_at("h", 1).alias("team"), F.element_at("h", 2).alias("number"), F.element_at("h", 3).alias("name"))  # a row a file
    body = parts.where(is_body).drop("value", "block", "at").join(heads, F.col("file") == F.col("of"))
    places = F.sequence(F.lit(LEADING), F.size("c") - 2, F.lit(2))
    text = lambda c: F.trim(F.get(c, F.col("i")))
    narrow = body.where(F.size("c") >= LEADING + 2).withColumn("i", F.explode(places))
    narrow = narrow.select("file", *(_number(F.get("c", F.lit(k)), kind).alias(n) for k, (n, kind) in enumerate({"period": "int", "frame": "long", "seconds": "double"}.items())), F.nullif(text("team"), F.lit("")).alias("team"), F.nullif(text("number"), F.lit("")).alias("number"), F.nullif(text("name"), F.lit("")).alias("player"), _number(F.get("c", F.col("i")), "double").alias("x"), _number(F.get("c", F.col("i") + 1), "double").alias("y"))
    return narrow.where("x is not null and y is not null")


def _sets_filled(batches):
    """Records in order to the frame set each one stands in, as far as its own range tells: null before the range's first one."""
    carried, file, block = None, None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        own = batch.column("set")
        # A set that a record opens holds for the records after it; at the start of a range nothing is known (an empty text, for now).
        before = pa.concat_arrays([pa.array([carried], pa.string()), own.slice(0, len(own) - 1)])
        new = pc.or_(pc.not_equal(batch.column("file"), pa.concat_arrays([pa.array([file], pa.string()), batch.column("file").slice(0, len(own) - 1)])), pc.not_equal(batch.column("block"), pa.concat_arrays([pa.array([block], pa.int64()), batch.column("block").slice(0, len(own) - 1)])))
        filled = pc.fill_null_forward(pc.if_else(pc.fill_null(new, True), pa.scalar(""), before))
        last = own[-1].as_py()
        carried, file, block = (last if last is not None else filled[-1].as_py()), batch.column("file")[-1].as_py(), batch.column("block")[-1].as_py()
        yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("block"), batch.column("record"), own, pc.if_else(pc.equal(filled, ""), pa.scalar(None, pa.string()), filled)], names=["file", "block", "record", "set", "inside"])


def xml_tracking(spark: SparkSession, path: str) -> DataFrame:
    """``file, section, match, team, player, frame, time, x, y`` of XML files of frame sets.

    Files are cut before any frame, also inside a set. A task carries the set it has seen last from frame to frame; a range that begins
    inside a set finds it as the last one that the ranges before it opened, a row a range. Attributes that are missing are null."""
    records = spark.read.text(path, lineSep=FRAME).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("record"))
    opened = F.element_at(F.regexp_extract_all("record", F.lit("<FrameSet\\s[^>]*>"), 0), -1)
    opened = F.when(F.col("record").contains("<FrameSet"), opened).when(F.col("record").contains("</FrameSet"), F.lit("<none>"))
    filled = records.withColumn("set", opened).select("file", "block", "record", "set").mapInArrow(_sets_filled, "file string, block long, record string, set string, inside string")
    # The records are in the ranges' order in the reader's tasks; a range's last set is the last that any of its records opens.
    order = records.select("file", "block", F.monotonically_increasing_id().alias("at"), opened.alias("set"))
    blocks = order.groupBy("file", "block").agg(F.max(F.when(F.col("set").isNotNull(), F.struct("at", "set")))["set"].alias("last"))  # a row a range
    before = F.last("last", ignorenulls=True).over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    begun = blocks.select("file", "block", before.alias("begun"))
    rows = filled.join(F.broadcast(begun), ["file", "block"]).withColumn("of", F.coalesce("inside", "begun"))
    attribute = lambda text, name: F.nullif(F.regexp_extract(text, rf'(?:^|\s){name}="([^"]*)"', 1), F.lit(""))
    frame = F.substring_index("record", ">", 1)
    # Texts first, numbers of them then: each attribute is searched for once.
    texts = rows.where(F.col("record").rlike(r'^\s*[A-Za-z][\w-]*="')).select("file", "of", frame.alias("frame"))
    texts = texts.select("file", *(attribute(F.col("of"), a).alias(n) for a, n in zip(SET, ("section", "match", "team", "player"), strict=True)), attribute(F.col("frame"), "N").alias("frame"), attribute(F.col("frame"), "T").alias("time"), *(attribute(F.col("frame"), c).alias(c.lower()) for c in "XY"))
    return texts.withColumns({"frame": _number(F.col("frame"), "long"), "x": _number(F.col("x"), "double"), "y": _number(F.col("y"), "double")})
