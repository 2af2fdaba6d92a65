"""Distinct rows by fingerprint: equal to the plain distinct, few bytes shuffled."""

from __future__ import annotations

import glob
import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from shopline.operators import clean as cln
from shopline.operators import distinct as dis

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def rows(df):
    return sorted(map(repr, df.collect()))


def counts(df):
    return tuple(dis.duplicate_rows(df).collect()[0])


def test_nulls_nan_and_zeros_are_equal_as_in_a_plain_distinct(spark):
    nan = float("nan")
    df = spark.createDataFrame(
        [(None, "a", 0.0), ("a", None, 0.0), (None, "a", -0.0), (None, None, nan), (None, None, nan), (None, None, None), ("", None, None)],
        "a string, b string, c double")
    assert dis.distinct_rows(df).count() == df.distinct().count() == 5
    assert counts(df) == (7, 2)


def test_hot_row_and_wide_rows(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("select"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("r"), F.col("id") % 19_000)).alias("with space"))
    assert rows(cln.dedupe(df, method="fingerprint")) == rows(df.distinct())
    assert counts(df) == (30_000, 9_999)


def test_bitmap_without_room_for_all_still_gives_whole_results(spark, monkeypatch):
    monkeypatch.setattr(dis, "LEAST_BITS", 64)
    monkeypatch.setattr(dis, "MOST_BITS", 64)
    df = spark.range(5_000).select((F.col("id") % 4_000).alias("v"), F.lit(1).alias("w"))
    assert rows(dis.distinct_rows(df)) == rows(df.distinct())


def test_equal_fingerprints_of_different_rows_are_compared(spark, monkeypatch):
    monkeypatch.setattr(dis, "fingerprint", lambda df: F.lit(7).cast("long") + F.length(F.col("v")) * 0)
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "v string")
    assert rows(dis.distinct_rows(df)) == rows(df.distinct())


def test_empty_no_repeats_and_nested_types(spark):
    empty = spark.createDataFrame([], "a string, b double")
    assert dis.distinct_rows(empty).count() == 0 and counts(empty) == (0, 0)
    single = spark.range(100)
    assert dis.distinct_rows(single).count() == 100 and counts(single) == (100, 0)
    nested = spark.createDataFrame([([1.0],), ([1.0],), (None,)], "v array<double>")
    assert dis.distinct_rows(nested).count() == 2 and counts(nested) == (3, 1)
    with pytest.raises(ValueError, match="method"):
        cln.dedupe(single, method="other")


JOB = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import functions as F
from shopline.session import checkpoint_dir, get_session
from shopline.operators.distinct import distinct_rows
spark = get_session("local[4]", app="shuffle-bytes", shuffle_partitions=8, extra={{"spark.eventLog.enabled": "true", "spark.eventLog.dir": {log!r}, "spark.eventLog.compress": "false", "spark.ui.enabled": "false"}})
checkpoint_dir(spark)
wide = spark.range(200_000).select("id", *[F.sha2((F.col("id") + i).cast("string"), 256).alias(f"c{{i}}") for i in range(6)])
distinct_rows(wide).write.format("noop").mode("overwrite").save()
spark.stop()
"""


def test_a_table_without_repeats_shuffles_under_20_bytes_a_row(tmp_dir):
    subprocess.run([sys.executable, "-c", JOB.format(root=ROOT, log=f"file://{tmp_dir}")], check=True, timeout=300)
    written = 0
    for path in glob.glob(f"{tmp_dir}/**/*", recursive=True):
        if os.path.isfile(path) and not os.path.basename(path).startswith(("appstatus", ".")):
            with open(path) as lines:
                for event in map(json.loads, lines):
                    if event["Event"] == "SparkListenerTaskEnd":
                        written += event["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"]
    assert 0 < written < 20 * 200_000
