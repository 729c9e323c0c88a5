"""Tracking feeds that are read by many tasks."""

from datetime import datetime

import pytest
from touchline.plans.trackers import s03_wide_csv_tracking
from touchline.sources.tracking import FRAME, wide_csv_tracking, xml_tracking


@pytest.fixture(params=["700", "5000", "128m"])
def ranges(spark, request):
    """Files are cut into ranges of so many bytes."""
    names = {"spark.sql.files.maxPartitionBytes": request.param, "spark.sql.files.openCostInBytes": "1"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield request.param
    for n, v in before.items():
        spark.conf.set(n, v)


def csv(path, match, frames, players):
    rows = [",,," + ",".join(f"{'Home' if p % 2 else 'Away'}," for p in players) + ",,", ",,," + ",".join(f"{p}," for p in players) + ",,", "Period,Frame,Time [s]," + ",".join(f"Player{p}," for p in players) + ",Ball,"]
    want = []
    for f in range(frames):
        cells = []
        for p in [*players, None]:
            there = (f + (p or 0)) % 5 > 0
            x, y = round(f / 1000 + (p or 0) / 10, 4), round(match + f / 100, 2)
            cells.append(f"{x},{y}" if there else "NaN,NaN" if f % 2 else ",")
            if there:
                want.append((1 + f // 100, f, f / 25, None if p is None else "Home" if p % 2 else "Away", None if p is None else str(p), "Ball" if p is None else f"Player{p}", x, y))
        rows.append(f"{1 + f // 100},{f},{f / 25}," + ",".join(cells))
    path.write_text("\n".join(rows) + "\n")
    return want


def test_wide_csv(spark, tmp_path, ranges):
    want = csv(tmp_path / "a.csv", 1, 230, [1, 2, 11]) + csv(tmp_path / "b.csv", 2, 90, [7, 3])
    got = wide_csv_tracking(spark, str(tmp_path))
    assert sorted((tuple(r)[1:] for r in got.collect()), key=str) == sorted(want, key=str)
    tasks = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
    assert tasks > 10 if ranges == "700" else tasks >= 1
    assert got.where("period is null or frame is null").count() == 0


def test_csv_that_is_broken(spark, tmp_path):
    (tmp_path / "x.csv").write_text(",,,H,\n,,,1,\nPeriod,Frame,Time [s],Player1,\n1,1,0.04,abc,2\n")
    with pytest.raises(Exception, match="not a double: abc"):
        wide_csv_tracking(spark, str(tmp_path / "x.csv")).collect()
    (tmp_path / "y.csv").write_text("Period,Frame,Time [s],Player1,\n1,1,0.04,1,2\n")
    with pytest.raises(Exception, match="three header lines"):
        wide_csv_tracking(spark, str(tmp_path / "y.csv")).collect()


def xml(path, match, sets, frames):
    out, want = ['<?xml version="1.0" encoding="utf-8"?>', "<PutDataRequest><Positions>"], []
    for s in range(sets):
        section, team, person = ("firstHalf", "secondHalf")[s % 2], ("T1", "T2", "BALL")[s % 3], f"P{s}"
        out.append(f'<FrameSet GameSection="{section}" MatchId="M{match}" TeamId="{team}" PersonId="{person}">')
        for f in range(frames if s != 2 else 0):  # one set has no frames
            x = round(s + f / 1000, 3)
            out.append(f'  <Frame N="{f}" T="2022-01-01T00:00:{f:03d}" X="{x}" Y="{-x}" S="1.0" M="1" />' if f % 7 else f'  <Frame N="{f}" X="{x}" />')
            want.append((section, f"M{match}", team, person, f, f"2022-01-01T00:00:{f:03d}" if f % 7 else None, x, -x if f % 7 else None))
        out.append("</FrameSet>")
    path.write_text("\n".join([*out, "</Positions></PutDataRequest>"]))
    return want


def test_xml_frame_sets(spark, tmp_path, ranges):
    want = xml(tmp_path / "a.xml", 1, 7, 60) + xml(tmp_path / "b.xml", 2, 3, 40)
    got = xml_tracking(spark, str(tmp_path))
    assert sorted((tuple(r)[1:] for r in got.collect()), key=str) == sorted(want, key=str)
    tasks = spark.read.text(str(tmp_path), lineSep=FRAME).rdd.getNumPartitions()
    assert tasks > 10 if ranges == "700" else tasks >= 1


def test_wide_csv_of_events(spark, tmp_path):
    """Players who miss frames at the start, inside and at the end of a line, and one without a number, keep their places."""
    seen = [(1, 0, 2), (1, 0, 9), (1, 1, 5), (1, 1, None), (2, 3, 5), (1, 2, 2), (1, 2, 5), (1, 2, 9), (1, 2, None)]
    rows = [(i, datetime(2024, 1, day, hour, 5), user, 12.0 * i) for i, (day, hour, user) in enumerate(seen)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, value double").write.parquet(str(tmp_path / "events.parquet"))
    got = s03_wide_csv_tracking(spark, str(tmp_path)).select("day", "frame", "team", "number", "player", "x", "y").collect()
    text = lambda u: None if u is None else str(u)
    want = [(f"2024-01-0{d}", h, "Home" if u is not None and u % 2 == 0 else "Away", text(u), None if u is None else f"Player{u}", 12.0 * i / 120, float(i)) for i, (d, h, u) in enumerate(seen)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
