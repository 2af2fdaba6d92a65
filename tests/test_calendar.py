"""Calendar rows per series before interpolation."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shopline.operators import clean as cln


def day(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


def test_each_series_gets_its_own_days(spark):
    df = spark.createDataFrame(
        [("a", day(0), 1.0, "x"), ("a", day(3), 7.0, "y"), ("b", day(5), 2.0, None), (None, day(1), 4.0, None), (None, day(3), 8.0, None)],
        "s string, date date, v double, note string")
    out = {(r["s"], r["date"]): (r["v"], r["note"]) for r in cln.interpolate(df, "date", "v", keys=["s"], calendar=True).collect()}
    assert out == {("a", day(0)): (1.0, "x"), ("a", day(1)): (3.0, None), ("a", day(2)): (5.0, None), ("a", day(3)): (7.0, "y"),
                   ("b", day(5)): (2.0, None), (None, day(1)): (4.0, None), (None, day(2)): (6.0, None), (None, day(3)): (8.0, None)}


def test_lines_run_over_calendar_days_not_positions(spark):
    df = spark.createDataFrame([(day(0), 0.0), (day(1), None), (day(10), 10.0)], "date date, v double")
    by_row = {r["date"]: r["v"] for r in cln.interpolate(df, "date", "v").collect()}
    by_day = {r["date"]: r["v"] for r in cln.interpolate(df, "date", "v", calendar=True).collect()}
    assert by_row[day(1)] == 5.0 and len(by_row) == 3
    assert by_day == {day(i): float(i) for i in range(11)}


def test_repeats_null_dates_empty_tables_and_wrong_types(spark):
    df = spark.createDataFrame([(day(0), 1), (day(0), 2), (day(2), 3), (None, 9)], "date date, v int")
    assert sorted((str(r["date"]), r["v"]) for r in cln.with_calendar(df, "date").collect()) == sorted(
        [(str(day(0)), 1), (str(day(0)), 2), (str(day(1)), None), (str(day(2)), 3), ("None", 9)])
    for schema_only in (df.filter("false"), df.filter("date is null")):
        assert cln.with_calendar(schema_only, "date").count() == schema_only.count()
    with pytest.raises(TypeError, match="date"):
        cln.with_calendar(spark.range(3).withColumnRenamed("id", "date"), "date")


def test_hot_series(spark):
    # One series has nearly all rows, many a day; every second day is missing.
    df = spark.range(40_000).select(F.when(F.col("id") % 50 == 0, F.lit("b")).otherwise(F.lit("a")).alias("s"),
                                    F.date_add(F.lit("2020-01-01").cast("date"), ((F.col("id") % 400) * 2).cast("int")).alias("date"),
                                    F.col("id").cast("double").alias("v"))
    out = cln.with_calendar(df, "date", ["s"])
    spans = df.groupBy("s").agg((F.datediff(F.max("date"), F.min("date")) + 1).alias("n"))
    assert {r["s"]: r["n"] for r in out.groupBy("s").agg(F.countDistinct("date").alias("n")).collect()} == {r["s"]: r["n"] for r in spans.collect()}
    assert out.filter("v is not null").count() == 40_000


def test_clean_step_with_calendar(spark):
    df = spark.createDataFrame([(day(0), 2.0), (day(4), 6.0)], "date date, p double")
    out, _ = cln.clean_table("oil", df, cln.CleanSpec(interpolate="p", impute=False, calendar=True))
    assert sorted(r["p"] for r in out.collect()) == [2.0, 3.0, 4.0, 5.0, 6.0]


def test_tasks_grow_in_number_not_in_rows(spark, monkeypatch):
    """Also a single series is dealt over tasks of bounded size, whatever the session's number of partitions."""
    monkeypatch.setattr(cln, "TASK_ROWS", 500)
    df = spark.range(12_000).select(F.lit("a").alias("s"), F.date_add(F.lit("1980-01-01").cast("date"), F.col("id").cast("int")).alias("date"),
                                    F.when(F.col("id") % 7 == 0, F.col("id").cast("double")).alias("v"))
    out = cln.interpolate(df, "date", "v", keys=["s"])
    got = out.select("v", F.spark_partition_id().alias("task")).collect()
    sizes = {}
    for r in got:
        sizes[r["task"]] = sizes.get(r["task"], 0) + 1
    assert len(sizes) >= 12 and max(sizes.values()) < 2500
    last = 11_999 - 11_999 % 7
    assert sorted(r["v"] for r in got) == sorted(float(min(i, last)) for i in range(12_000))
