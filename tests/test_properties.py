"""Invariants on random data: results do not depend on partitioning or row order."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shopline.functions.sizing import bounded_broadcast
from shopline.operators.ordering import exact_median, exact_medians, global_position
from shopline.plans import marts

WIDE = ("date date, store_nbr long, family string, sales double, onpromotion double, city string, "
        "state string, type string, transactions long, dcoilwtico double, is_national_holiday boolean")

rows = st.lists(st.tuples(
    st.integers(0, 40), st.integers(1, 6), st.sampled_from("ABCD"),
    st.integers(0, 10_000_00), st.integers(0, 3), st.booleans()), min_size=1, max_size=60)


def as_wide(spark, data):
    out = [(dt.date(2015, 1, 1) + dt.timedelta(days=d), s, f, c / 100.0, float(p), f"c{s % 3}", "s", "T",
            s * 3, 50.0 + d, h) for d, s, f, c, p, h in data]
    return spark.createDataFrame(out, WIDE)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows)
def test_marts_independent_of_partitioning(spark, data):
    df = as_wide(spark, data)
    for mart in (marts.sales_by_family, marts.store_ranking, marts.holiday_window, marts.promotion_uplift):
        one = sorted(map(tuple, mart(df.repartition(1)).collect()), key=repr)
        many = sorted(map(tuple, mart(df.repartition(7).orderBy("sales")).collect()), key=repr)
        assert one == many


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-50, 50), min_size=0, max_size=80))
def test_exact_median_matches_sorting(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x long").repartition(5)
    got = exact_median(df, "x").collect()[0]["median"]
    if not values:
        assert got is None
    else:
        s = sorted(values)
        n = len(s)
        assert got == (s[(n - 1) // 2] + s[n // 2]) / 2


def test_exact_medians_equal_the_builtin_with_nan_and_many_values(spark):
    df = spark.range(24_000).selectExpr(
        "double(pmod(id * 7919, 12007)) as many",
        "CASE id % 4 WHEN 0 THEN double('NaN') WHEN 1 THEN 2.0 WHEN 2 THEN 4.0 END as some",
        "if(id % 3 = 0, double(id), 5.0) as hot", "cast(null as long) as none")
    got = {r["column"]: r["median"] for r in exact_medians(df, df.columns).collect()}
    want = df.agg(*[F.median(c).alias(c) for c in df.columns]).collect()[0].asDict()
    assert got == want and want["none"] is None


@pytest.mark.parametrize("partitions", [6, None])
def test_hot_key_rank_positions(spark, partitions):
    # One store holds a third of the rows; positions stay a permutation of 0..n-1
    # (None: AQE decides how many range partitions).
    df = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS v")
    pos = global_position(df, [df.v.asc(), df.id.asc()], partitions=partitions)
    got = [r["position"] for r in pos.orderBy("v", "id").collect()]
    assert got == list(range(3000))


def test_broadcast_only_of_measured_small_sides(spark):
    text = lambda known: bounded_broadcast(spark.range(100), known)._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" in text((100, 800))
    assert "broadcast" not in text((3_000_000, 800)) and "broadcast" not in text((100, 1 << 30)) and "broadcast" not in text(None)
