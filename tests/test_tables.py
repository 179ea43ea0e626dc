"""Reuse of stored results: only while plan and input files are the same."""

import os

import pytest
from pyspark.sql import functions as F

from panelwright.sources import standins, tables as T


@pytest.fixture
def source(spark, tmp_path):
    path = str(tmp_path / "in put")
    spark.range(10).withColumn("v", F.col("id") % 3).write.parquet(path)
    return path


def written(path):
    return {f: os.stat(f"{path}/{f}").st_mtime_ns for f in os.listdir(path) if f.startswith("part")}


def test_same_plan_over_same_files_is_reused(spark, source, tmp_path):
    out = str(tmp_path / "out")
    build = lambda: spark.read.parquet(source).groupBy("v").agg(F.count("*").alias("n"))
    want = sorted(map(tuple, T.materialize(build(), out).collect()))
    first = written(out)
    assert sorted(map(tuple, T.materialize(build(), out).collect())) == want and written(out) == first
    T.materialize(build(), out, force=True)
    assert written(out) != first


def test_changed_input_gives_its_new_rows(spark, source, tmp_path):
    out = str(tmp_path / "out")
    build = lambda: spark.read.parquet(source).agg(F.sum("id").alias("s"))
    assert T.materialize(build(), out).first()["s"] == 45
    spark.range(100, 101).withColumn("v", F.col("id") % 3).write.mode("append").parquet(source)
    assert T.materialize(build(), out).first()["s"] == 145
    spark.range(5).withColumn("v", F.col("id") % 3).write.mode("overwrite").parquet(source)
    assert T.materialize(build(), out).first()["s"] == 10


def test_changed_plan_is_run(spark, source, tmp_path):
    out = str(tmp_path / "out")
    rows = spark.read.parquet(source)
    assert T.materialize(rows.where("id < 5").agg(F.sum("id").alias("s")), out).first()["s"] == 10
    assert T.materialize(rows.where("id < 6").agg(F.sum("id").alias("s")), out).first()["s"] == 15


def test_rows_that_are_no_files_are_never_taken_for_the_same(spark, tmp_path):
    out = str(tmp_path / "out")
    for rows in ([(1,)], [(2,)]):
        df = spark.createDataFrame(rows, "x int")
        assert T.manifest(df) is None and T.materialize(df, out).collect() == df.collect()


def test_an_unfinished_result_is_written_again(spark, source, tmp_path):
    out = str(tmp_path / "out")
    rows = spark.read.parquet(source)
    T.materialize(rows, out)
    os.remove(f"{out}/_SUCCESS")
    first = written(out)
    assert T.materialize(rows, out).count() == 10 and written(out) != first


@pytest.mark.parametrize("kind, unit", [("timestamp_ntz", "us"), ("timestamp_ntz", "ms"), ("timestamp", "us"), ("date", None), ("bigint", None)])
def test_newest_value_comes_from_footers(spark, tmp_path, kind, unit):
    import datetime as dt

    import pyarrow as pa
    import pyarrow.parquet as pq
    days = [dt.datetime(1965, 3, 1, 5, 6, 7, 8000), dt.datetime(2024, 2, 29, 23, 59, 59, 999000), None, dt.datetime(1999, 1, 1)]
    for part, values in enumerate((days[:1], days[1:3], days[3:], [None])):
        if kind == "bigint":
            column = pa.array([v and v.toordinal() for v in values], pa.int64())
        elif kind == "date":
            column = pa.array([v and v.date() for v in values], pa.date32())
        else:
            column = pa.array(values, pa.timestamp(unit, "UTC" if kind == "timestamp" else None))
        os.makedirs(tmp_path / "t", exist_ok=True)
        pq.write_table(pa.table({"x": column, "y": pa.array([1] * len(values))}), tmp_path / "t" / f"{part}.parquet")
    path = str(tmp_path / "t")
    assert dict(spark.read.parquet(path).dtypes)["x"] == kind
    want = spark.read.parquet(path).agg(F.max("x")).first()[0]
    assert want is not None and T.newest(spark, path, "x") == want
    with T.settings(spark, T.FROM_FOOTERS):
        text = spark.read.schema("x bigint" if "time" in kind else f"x {kind}").parquet(path).agg(F.max("x"))
        assert "PushedAggregation: [MAX(x)]" in text._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_newest_of_nothing_partitions_and_missing_statistics(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq
    empty, plain, parts = (str(tmp_path / n) for n in ("empty", "plain.parquet", "parts"))
    spark.range(0).write.parquet(empty)
    assert T.newest(spark, empty, "id") is None
    pq.write_table(pa.table({"x": pa.array([3, 9, 4])}), plain, write_statistics=False)
    assert T.newest(spark, plain, "x") == 9
    spark.range(30).withColumn("month", F.concat(F.lit("2026-0"), (F.col("id") % 4).cast("string"))).write.partitionBy("month").parquet(parts)
    assert T.newest(spark, parts, "month") == "2026-03"
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != T.FROM_FOOTERS["spark.sql.sources.useV1SourceList"]


def test_page_table_counts_days_without_expanding_lines(spark, tmp_path):
    """Two distinct counts as plain aggregates copy every line and keep an entry of each (part, day) in a task."""
    days = ["1998-01-01", "1998-01-01", "1999-12-31", "2000-02-29", "2000-12-31", "2000-12-31", "2001-01-01"]
    lines = spark.createDataFrame([(1, d, 0.03 * (i % 2)) for i, d in enumerate(days)], "l_partkey long, d string, l_tax double")
    lines.selectExpr(
        "l_partkey", "CAST(d AS TIMESTAMP_NTZ) AS l_shipdate", "l_tax", "2.0D AS l_quantity", "0.5D AS l_discount",
        "300.0D AS l_extendedprice", "'R' AS l_returnflag", "'O' AS l_linestatus", "1 AS l_linenumber",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, "b", "x y", "t", 10, 5.0) for k in (1, 2)], "p_partkey long, p_brand string, p_name string, p_type string, p_size int, p_retailprice double") \
        .write.parquet(f"{tmp_path}/part.parquet")
    pages = standins.page_table(spark, str(tmp_path))
    assert "Expand" not in pages._jdf.queryExecution().executedPlan().toString()
    rows = {r["content_id"]: r for r in pages.collect()}
    assert (rows["1"]["days_with_impressions"], rows["1"]["days_with_sessions"]) == (4, 3)
    assert (rows["1"]["impressions_90d"], rows["1"]["pageviews_90d"], rows["1"]["sessions_last_30d"]) == (12, 54, 12)
    assert rows["2"]["days_with_impressions"] is None
