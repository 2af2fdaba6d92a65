"""Versioned publishing: readers see a whole run or the one before."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from shopline.plans import workflow
from shopline.sinks import versions, writers
from shopline.sources import roles


def by_year(spark, years):
    days = [(f"{y}-06-01", float(y)) for y in years]
    return spark.createDataFrame(days, "day string, sales double").select(F.col("day").cast("date").alias("date"), "sales")


def publish(spark, root, years):
    with versions.new_version(spark, root) as folder:
        writers.write_consolidated(by_year(spark, years), f"{folder}/wide")


def years_of(spark, root):
    return sorted(r["year"] for r in versions.read_published(spark, root, "wide").collect())


def test_a_new_version_replaces_all_years(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        versions.current(spark, tmp_dir)
    publish(spark, tmp_dir, [2013, 2014])
    assert years_of(spark, tmp_dir) == [2013, 2014]
    publish(spark, tmp_dir, [2015])
    assert years_of(spark, tmp_dir) == [2015]


def test_a_failed_run_leaves_the_former_tables(spark, tmp_dir):
    publish(spark, tmp_dir, [2013])
    fails = by_year(spark, [2014, 2015]).withColumn("sales", F.when(F.year("date") == 2015, F.raise_error(F.lit("lost"))).otherwise(F.col("sales")))
    with pytest.raises(Exception, match="lost"):
        with versions.new_version(spark, tmp_dir) as folder:
            writers.write_parquet(by_year(spark, [2014]), f"{folder}/other")
            writers.write_parquet(fails, f"{folder}/wide")
    assert years_of(spark, tmp_dir) == [2013]
    assert len(os.listdir(f"{tmp_dir}/versions")) == 2  # the dead run's folder, until it expires


def test_a_reader_keeps_its_version(spark, tmp_dir):
    publish(spark, tmp_dir, [2013])
    reading = versions.read_published(spark, tmp_dir, "wide")
    publish(spark, tmp_dir, [2014])
    assert [r["year"] for r in reading.collect()] == [2013]


def test_expire_keeps_the_last_and_what_is_being_written(spark, tmp_dir):
    for y in (2013, 2014, 2015):
        publish(spark, tmp_dir, [y])
    os.makedirs(f"{tmp_dir}/versions/running")
    os.makedirs(f"{tmp_dir}/versions/dead")
    os.utime(f"{tmp_dir}/versions/dead", (1_000_000_000, 1_000_000_000))
    first = versions.commits(spark, tmp_dir)[0][1]
    assert sorted(versions.expire(spark, tmp_dir, keep=2)) == sorted([first, "dead"])
    assert years_of(spark, tmp_dir) == [2015]
    assert [n for n, _ in versions.commits(spark, tmp_dir)] == [2, 3]
    assert first not in os.listdir(f"{tmp_dir}/versions") and "running" in os.listdir(f"{tmp_dir}/versions")
    publish(spark, tmp_dir, [2016])
    assert [n for n, _ in versions.commits(spark, tmp_dir)] == [2, 3, 4]
    with pytest.raises(ValueError):
        versions.expire(spark, tmp_dir, keep=0)


def test_batch_run_is_published_as_a_whole(spark, tmp_dir):
    tables = roles.raw_inputs(spark, "/root/testdata/sf0.001")
    result = workflow.run_published(spark, tables, tmp_dir, period=roles.PERIOD)
    assert versions.read_published(spark, tmp_dir, "consolidated").count() == result.rows["consolidated"]
    assert versions.read_published(spark, tmp_dir, "marts/sales_by_family").count() == result.rows["sales_by_family"]
    before = versions.current(spark, tmp_dir)
    broken = tables | {"oil": tables["oil"].withColumn("dcoilwtico", F.lit(None).cast("double"))}
    with pytest.raises(ValueError, match="nulls remain"):
        workflow.run_published(spark, broken, tmp_dir)
    assert versions.current(spark, tmp_dir) == before
