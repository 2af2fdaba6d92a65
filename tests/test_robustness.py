"""Re-runs, malformed input, extreme values, long series, session settings."""

from __future__ import annotations

import datetime as dt
import math
import time

import pytest
from pyspark.sql import functions as F

from shopline import session
from shopline.functions.stats import exact_avg, exact_sum
from shopline.operators import aggregates as agg
from shopline.operators import clean as cln
from shopline.plans import catalog, marts
from shopline.schemas import INPUTS
from shopline.sinks import writers
from shopline.sources import csv as csvsrc


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_second_run_replaces_all_years(spark, tmp_dir):
    days = spark.createDataFrame([(dt.date(2013, 1, 1), 1.0), (dt.date(2014, 6, 1), 2.0)], "date date, sales double")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        writers.write_consolidated(days, f"{tmp_dir}/c")
        writers.write_consolidated(days.where("year(date) = 2014"), f"{tmp_dir}/c")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [r["year"] for r in spark.read.parquet(f"{tmp_dir}/c").collect()] == [2014]


def write_inputs(spark, tmp_dir, stores: str, train: str) -> dict[str, str]:
    text = {"stores": stores, "train": train, "transactions": "date,store_nbr,transactions\n2013-01-01,1,5\n",
            "oil": "date,dcoilwtico\n2013-01-01,\n2013-01-02,93.1\n",
            "holidays": ",".join(INPUTS["holidays"].fieldNames()) + "\n2013-01-01,Holiday,National,Ecuador,New Year,false\n"}
    paths = {}
    for name, body in text.items():
        paths[name] = f"{tmp_dir}/{name}.csv"
        with open(paths[name], "w") as f:
            f.write(body)
    return paths


TRAIN = ",".join(INPUTS["train"].fieldNames()) + "\n1,2013-01-01,1,BREAD,2.5,0\n" + '"2,2013-01-01,1,""A,B"",,0"\n'
STORES = "store_nbr,city,state,type,cluster\n1,Quito,Pichincha,A,3\n"


def test_load_audit_counts_repairs_and_nulls(spark, tmp_dir):
    tables, audit = csvsrc.load_all(spark, write_inputs(spark, tmp_dir, STORES, TRAIN))
    got = {r["table"]: (r["rows"], r["columns"], r["nulls"], r["repaired"]) for r in audit.collect()}
    assert got["train"] == (2, 6, 1, 1) and got["oil"] == (2, 2, 1, 0) and got["stores"] == (1, 5, 0, 0)
    assert tables["train"].columns == INPUTS["train"].fieldNames()


@pytest.mark.parametrize("stores, train", [
    (STORES.replace(",3", ",notanumber"), TRAIN),
    (STORES, TRAIN + "garbage\n"),
    (STORES.replace("city,state", "state,city"), TRAIN),
])
def test_load_audit_fails_on_bad_cell_line_or_header(spark, tmp_dir, stores, train):
    _, audit = csvsrc.load_all(spark, write_inputs(spark, tmp_dir, stores, train))
    with pytest.raises(Exception):  # noqa: B017  (Spark's own error types differ by case)
        audit.collect()


def test_sums_keep_small_large_and_nan_values(spark):
    one = lambda *v: spark.createDataFrame([(x,) for x in v], "x double").agg(
        exact_sum("x").alias("s"), exact_avg("x").alias("m")).collect()[0]
    assert one(0.00004, 0.00004)["s"] == 0.00008
    assert one(2e14, 0.25)["s"] == 2e14 + 0.25
    assert one(1e30, 1.0)["s"] == 1e30
    assert math.isnan(one(1.0, float("nan"))["s"])
    assert one(None)["s"] is None and one(None)["m"] is None


def test_monthly_price_is_the_plain_mean(spark):
    rows = [(dt.date(2015, 1, d), 1.0, 50.0 + d / 7) for d in range(1, 29)]
    df = spark.createDataFrame(rows, "date date, sales double, p double")
    got = agg.monthly_series(df, "date", "sales", "p").collect()[0]["avg_price"]
    assert math.isclose(got, sum(r[2] for r in rows) / len(rows), rel_tol=1e-14)


def test_interpolation_is_linear_in_the_series(spark):
    n = 300_000
    df = spark.range(n).select(F.date_add(F.lit("1200-01-01").cast("date"), F.col("id").cast("int")).alias("date"),
                               F.when(F.col("id") % 50 == 0, F.col("id") * 2.0).alias("p"))
    began = time.time()
    out = cln.interpolate(df, "date", "p", fill_edges=False)
    off = F.abs(F.col("p") - 2 * F.datediff("date", F.lit("1200-01-01").cast("date")))
    row = out.agg(F.count("p").alias("n"), F.max(off).alias("off")).collect()[0]
    assert row["n"] == n - (n - 1) % 50 and row["off"] < 1e-6
    assert time.time() - began < 60
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and "_known" in line]
    assert windows and all("[_pid#" in line for line in windows)


def test_all_null_price_series_stops_the_run(spark):
    df = spark.createDataFrame([(dt.date(2015, 1, 1), None)], "date date, dcoilwtico double")
    with pytest.raises(ValueError):
        cln.assert_no_nulls(cln.interpolate(df, "date", "dcoilwtico"), ["dcoilwtico"])


@pytest.fixture(scope="module")
def wide(spark):
    return catalog.consolidated(spark, "/root/testdata/sf0.001")


def test_marts_read_the_facts_once(spark, wide):
    for mart in (marts.sales_by_family, marts.top_families, marts.holiday_window):
        assert final_plan(mart(wide)).count("FileScan") <= (1 if mart is not marts.holiday_window else 2)


def test_later_marts_start_few_jobs(spark, wide):
    sc = spark.sparkContext
    for mart in ("sales_by_family", "store_ranking", "holiday_window", "lag_corr"):
        sc.setJobGroup(f"build-{mart}", mart)
        catalog.QUERIES[mart](spark, "/root/testdata/sf0.001")
        assert len(sc.statusTracker().getJobIdsForGroup(f"build-{mart}")) <= 10
    sc.setLocalProperty("spark.jobGroup.id", None)


def test_open_session_keeps_its_settings(spark):
    old = spark.conf.get("spark.sql.adaptive.skewJoin.enabled")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        assert session.get_session().conf.get("spark.sql.adaptive.skewJoin.enabled") == "false"
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", old)


def test_stored_tables_can_be_dropped(spark):
    df = session.cut_lineage(spark.range(5).toDF("id"))
    assert df.count() == 5
    session.drop_stored(df)
    with pytest.raises(Exception):  # noqa: B017
        spark.read.parquet(df._stored_at)
