"""Sinks: Parquet round trip and JDBC into embedded in-memory Derby (no port)."""

from __future__ import annotations

import uuid

from shopline.sinks import writers

DERBY = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def derby_url():
    return f"jdbc:derby:memory:t{uuid.uuid4().hex[:8]};create=true"


def read_jdbc(spark, url, table):
    return spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**DERBY).load()


def test_parquet_consolidated_roundtrip(spark, tmp_dir):
    import datetime as dt
    df = spark.createDataFrame([(dt.date(2013, 1, 1), 1.0), (dt.date(2014, 6, 1), 2.0)], "date date, sales double")
    writers.write_consolidated(df, f"{tmp_dir}/c")
    back = spark.read.parquet(f"{tmp_dir}/c")
    assert sorted(r["year"] for r in back.collect()) == [2013, 2014]


def test_jdbc_overwrite_then_append(spark):
    url = derby_url()
    df = spark.range(25_000).selectExpr("id", "cast(id * 0.5 as double) as v")
    writers.write_jdbc(df, url, "T1", properties=DERBY, num_partitions=4)
    assert read_jdbc(spark, url, "T1").count() == 25_000
    writers.write_jdbc(df, url, "T1", mode="append", properties=DERBY, num_partitions=4)
    assert read_jdbc(spark, url, "T1").count() == 50_000
    writers.write_jdbc(df.limit(10), url, "T1", properties=DERBY)
    assert read_jdbc(spark, url, "T1").count() == 10


def test_jdbc_empty_frame_creates_table(spark):
    url = derby_url()
    writers.write_jdbc(spark.range(0).selectExpr("id"), url, "EMPTY_T", properties=DERBY)
    back = read_jdbc(spark, url, "EMPTY_T")
    assert back.count() == 0 and [c.lower() for c in back.columns] == ["id"]


def test_export_all_reports_failures_and_continues(spark, tmp_dir):
    done = []

    def sink(df, name):
        df.write.mode("overwrite").parquet(f"{tmp_dir}/{name}")
        done.append(name)

    def broken():
        raise RuntimeError("cannot build")

    audit = writers.export_all(spark, {"a": lambda: spark.range(3), "b": broken, "c": lambda: spark.range(2)}, sink)
    status = {r["table"]: r["status"] for r in audit.collect()}
    assert status == {"a": "ok", "b": "failed", "c": "ok"} and done == ["a", "c"]


def test_stored_table_is_written_by_year_without_a_shuffle(spark, tmp_dir):
    """More years than a task holds open, null dates, and the session's setting as before."""
    from pyspark.sql import functions as F

    from shopline.session import cut_lineage
    from shopline.sinks import writers
    days = F.when(F.col("id") % 9 > 0, F.date_add(F.lit("1970-01-01").cast("date"), (F.col("id") * 90).cast("int")))
    wide = cut_lineage(spark.range(400).select("id", days.alias("date")))
    before = spark.conf.get(writers.OPEN_FILES_CONF)
    spark.sparkContext.setJobGroup("by-year", "write by year")
    try:
        writers.write_consolidated(wide, f"{tmp_dir}/wide", rebalance=False)
        tracker = spark.sparkContext.statusTracker()
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("by-year")]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [len(j.stageIds) for j in jobs] == [1]
    assert spark.conf.get(writers.OPEN_FILES_CONF) == before
    back = spark.read.parquet(f"{tmp_dir}/wide")
    assert {(r["id"], r["date"]) for r in back.collect()} == {(r["id"], r["date"]) for r in wide.collect()} and back.count() == 400
    assert back.filter("year IS DISTINCT FROM year(date)").isEmpty() and back.select("year").distinct().count() > writers.OPEN_FILES
