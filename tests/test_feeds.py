"""Field maps with absent, nested and wrong values; control surfaces and transport distance against direct sums."""

import math

import pytest
from pyspark.sql import functions as F
from touchline.operators.kinematics import control_surface
from touchline.operators.monitors import transport_distance
from touchline.sources.fields import Field, csv_fields, json_fields, xml_fields


def test_json_paths(spark):
    lines = spark.createDataFrame([('{"id": 1, "p": {"xy": [1.5, 2]}, "extra": "é"}',), ('{"id": 2, "p": null}',), (None,)], "value string")
    fields = [Field("id", "$.id", "bigint"), Field("y", "$.p.xy[1]", "double"), Field("p", "$.p", "json")]
    got = [tuple(r) for r in json_fields(lines, fields).collect()]
    assert got[0] == (1, 2.0, '{"xy":[1.5,2]}') and got[1][:2] == (2, None) and got[2] == (None, None, None)
    for text, field in [('{"id": "x"}', Field("id", "$.id", "bigint")), ("{}", Field("id", "$.id", "bigint", required=True)), ("{", Field("id", "$.id"))]:
        with pytest.raises(Exception):
            json_fields(spark.createDataFrame([(text,)], "value string"), [field]).collect()


def test_csv_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name,other\n1,"a ""b"", c",x\n2,,y\n')
    fields = [Field("id", "id", "bigint", required=True), Field("name", "name"), Field("gone", "gone", "double")]
    assert [tuple(r) for r in csv_fields(spark, str(tmp_path / "a.csv"), fields).orderBy("id").collect()] == [(1, 'a "b", c', None), (2, None, None)]
    with pytest.raises(Exception, match="not a bigint"):
        csv_fields(spark, str(tmp_path / "a.csv"), [Field("id", "name", "bigint")]).collect()
    with pytest.raises(Exception, match="no value"):
        csv_fields(spark, str(tmp_path / "a.csv"), [Field("name", "name", required=True)]).collect()


def test_xml_attributes(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<m><e id="1"><at x="0.5"/><tag n="3"/><tag n="4"/><late/></e><e id="2"/></m>')
    fields = [Field("id", "@id", "int"), Field("x", "at/@x", "double"), Field("tags", "tag[]/@n", "int"), Field("late", "late?")]
    assert [tuple(r) for r in xml_fields(spark, str(tmp_path / "a.xml"), "e", fields).orderBy("id").collect()] == [(1, 0.5, [3, 4], True), (2, None, [], False)]


def test_surface_by_hand(spark):
    players = [(1, True, 10.0, 10.0, 1.0, 0.0), (1, True, 30.0, 40.0, 0.0, 0.0), (1, False, 60.0, 20.0, -2.0, 1.0), (1, False, 5.0, None, 0.0, 0.0), (2, True, 1.0, 1.0, 0.0, 0.0), (3, False, 1.0, 1.0, 0.0, 0.0)]
    got = {(r.f, r.cell): r.home_control for r in control_surface(spark.createDataFrame(players, "f int, home boolean, x double, y double, vx double, vy double"), ["f"], F.col("home"), 3, 2).collect()}
    assert len(got) == 18 and {got[2, c] for c in range(6)} == {1.0} and {got[3, c] for c in range(6)} == {0.0}
    for cell in range(6):
        gx, gy = (cell % 3) * 52.5, (cell // 3) * 68.0
        time = {True: [], False: []}
        for _, home, x, y, vx, vy in (p for p in players if p[0] == 1 and p[3] is not None):
            d = math.hypot(gx - x, gy - y)
            v = (vx * (gx - x) + vy * (gy - y)) / d
            time[home].append(max(0.7, 0.7 + (math.sqrt(v * v + 14 * d) - v) / 7))
        part = {h: sum(1 / (1 + math.exp(max(-50, min(50, (t - min(time[not h])) * math.pi / math.sqrt(3) / 0.45)))) for t in time[h]) for h in time}
        assert got[1, cell] == pytest.approx(part[True] / (part[True] + part[False]), abs=1e-9)


def test_transport_ranges_do_not_matter(spark):
    rows = spark.createDataFrame([("a", float(v), n) for v, n in [(1, True), (2, True), (9, True), (4, False), (40, False)]] + [("a", None, True), ("b", 3.0, True), ("b", 3.0, False)], "g string, v double, n boolean")
    for width in (0.5, 5, 100):
        got = {r.g: r.wasserstein for r in transport_distance(rows, ["g"], "v", F.col("n"), width).collect()}
        assert got == {"a": pytest.approx(18.0), "b": 0.0}, width
