"""Replacing a database table as a whole, in embedded in-memory Derby (no port)."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from shopline.sinks import staged, writers

DERBY = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


@pytest.fixture()
def url():
    return f"jdbc:derby:memory:s{uuid.uuid4().hex[:8]};create=true"


def read(spark, url, table):
    return spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**DERBY).load()


def tables(spark, url):
    return {r[0] for r in read(spark, url, "(SELECT TABLENAME FROM SYS.SYSTABLES WHERE TABLETYPE = 'T') t").collect()}


def test_replaces_rows_and_columns(spark, url):
    assert staged.replace_table(spark.range(5_000), url, "T1", properties=DERBY, num_partitions=4) == 5_000
    new = spark.range(10).select("id", F.lit("x").alias("note"))
    assert staged.replace_table(new, url, "T1", properties=DERBY) == 10
    assert sorted(map(tuple, read(spark, url, "T1").collect())) == [(i, "x") for i in range(10)]
    assert staged.replace_table(spark.range(0), url, "T1", properties=DERBY) == 0
    assert read(spark, url, "T1").count() == 0 and tables(spark, url) == {"T1"}


def test_a_failing_partition_leaves_the_old_table_whole(spark, url):
    staged.replace_table(spark.range(100), url, "T1", properties=DERBY)
    broken = spark.range(0, 1_000, 1, 4).select(F.when(F.col("id") == 900, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        staged.replace_table(broken, url, "T1", properties=DERBY, num_partitions=4)
    assert sorted(r[0] for r in read(spark, url, "T1").collect()) == list(range(100))
    assert tables(spark, url) == {"T1"}


def test_doubled_rows_are_refused(spark, url, monkeypatch):
    staged.replace_table(spark.range(3), url, "T1", properties=DERBY)
    write = writers.write_jdbc

    def doubled(df, url, table, **options):
        write(df, url, table, **options)
        write(spark.range(1), url, table, mode="append", properties=DERBY)

    monkeypatch.setattr(writers, "write_jdbc", doubled)
    with pytest.raises(RuntimeError, match="4 rows sent, 5 stored"):
        staged.replace_table(spark.range(4), url, "T1", properties=DERBY)
    assert read(spark, url, "T1").count() == 3 and tables(spark, url) == {"T1"}


def test_unknown_database(spark):
    with pytest.raises(ValueError, match="one transaction"):
        staged.replace_table(spark.range(1), "jdbc:other://host/db", "T1")
