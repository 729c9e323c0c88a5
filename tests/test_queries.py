"""Every registered query with SQL against DuckDB on the small tables."""

import duckdb
import pandas as pd
import pytest
from touchline.plans import registry
from touchline.streaming.windows import streamed_hourly_counts


def rows(df):
    df = df[sorted(df.columns)]
    value = lambda x: None if pd.isna(x) else round(float(x), 6) if isinstance(x, (int, float)) else str(x)
    return sorted(str([value(x) for x in r]) for r in df.astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings", "documents"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", registry.SQL)
def test_query(spark, sf, db, name):
    assert rows(registry.QUERIES[name](spark, sf).toPandas()) == rows(db.sql(registry.SQL[name]).df())


def test_stream_equals_batch(spark, sf, tmp_path):
    spark.read.parquet(f"{sf}/events.parquet").repartition(3).write.parquet(f"{tmp_path}/events")
    assert rows(streamed_hourly_counts(spark, f"{tmp_path}/events").toPandas()) == rows(registry.QUERIES["s01_tumbling_windows"](spark, sf).toPandas())


def test_pitch_systems_and_strict_parsers(spark):
    import pytest as pt
    from pyspark.sql import functions as F
    from touchline.functions.parsing import clock_seconds, exact_millimetres
    from touchline.functions.pitch import normalized

    with pt.raises(ValueError, match="unknown"):
        normalized(F.lit(1.0), F.lit(1.0), "feet")
    texts = ["01:02:03.5", "02:03", "2:61", "x", "", None, "1:2:3"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(clock_seconds(F.col("t"))).collect()]
    assert got == [3723.5, 123.0, None, None, None, None, None]
    numbers = ["1.234", "1.2340", "1.2345", "-3", "1e3", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in numbers], "t string").select(exact_millimetres(F.col("t"))).collect()]
    assert got == [1234, 1234, None, -3000, None, None]


def test_merge_keeps_other_partitions_and_adds_rows(spark, tmp_path):
    from touchline.sources.merging import merge

    path = f"{tmp_path}/merged"
    spark.createDataFrame([(1, "a", 1), (2, "a", 1), (3, "b", 1)], "k int, p string, v int").write.partitionBy("p").parquet(path)
    before = {f.name for f in (tmp_path / "merged" / "p=b").iterdir()}
    merge(spark, path, spark.createDataFrame([(2, "a", 5), (4, "a", 5), (4, "a", 5), (7, "c", 5)], "k int, p string, v int"), ["k", "p"], "p")
    assert sorted((r.k, r.p, r.v) for r in spark.read.parquet(path).collect()) == [(1, "a", 1), (2, "a", 5), (3, "b", 1), (4, "a", 5), (7, "c", 5)]
    assert {f.name for f in (tmp_path / "merged" / "p=b").iterdir()} == before


def test_components_of_paths_loops_and_nulls(spark):
    from touchline.operators.graph import connected_components

    def stage(df, name):
        return spark.createDataFrame(df.collect(), df.schema)

    links = spark.createDataFrame([(5, 4), (4, 3), (3, 2), (9, 9), (8, 7), (7, 8), (None, 1), (2, 5)], "a int, b int")
    got = {r.node: r.component for r in connected_components(links, stage).collect()}
    assert got == {2: 2, 3: 2, 4: 2, 5: 2, 7: 7, 8: 7}
