"""Marts from one scan, and sums and means that don't depend on the order of rows."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from shopline.functions.stats import Partial, exact_avg, exact_mean, exact_sum, given, partial_mean, partial_sum
from shopline.operators.rollup import rollup
from shopline.plans import catalog, marts

SF_DIR = "/root/testdata/sf0.001"


def rows_of(df) -> list[tuple]:
    return list(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def wide(spark):
    return catalog.consolidated(spark, SF_DIR)


@pytest.fixture(scope="module")
def builds(wide):
    return marts.run_all(wide, catalog.PERIOD)


@pytest.mark.parametrize("name", sorted(marts.MARTS))
def test_mart_from_partial_sums_equals_mart_from_rows(wide, builds, name):
    assert rows_of(builds[name]()) == rows_of(marts.registry(catalog.PERIOD)[name](wide))


def test_ranking_beyond_one_task(wide, builds, monkeypatch):
    """The same ranks where the measured size is too large for one task."""
    from shopline.operators import aggregates
    want = rows_of(builds["store_ranking"]())
    monkeypatch.setattr(aggregates, "ONE_TASK_ROWS", 1)
    text = builds["store_ranking"]()._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in text and rows_of(builds["store_ranking"]()) == want


def test_period_that_cuts_months(wide):
    period = ("1997-02-11", "1998-08-05")
    some = marts.run_all(wide, period)
    for name in ("lag_corr", "city_price_corr"):
        assert rows_of(some[name]()) == rows_of(marts.registry(period)[name](wide))
    with pytest.raises(ValueError):
        marts.city_price_corr(marts.shared_facts(wide, period)["store"], period=catalog.PERIOD)


def test_groups_do_not_grow_with_store_months(spark):
    """Stores that sell a row a month: no grain has a group for each store and month."""
    stores, months = 40, 24
    df = spark.range(stores * months).selectExpr(
        f"add_months(date'2015-01-05', cast(id % {months} as int)) as date", f"id div {months} as store_nbr", "'F' as family", "id * 0.25D as sales",
        "id % 2 as onpromotion", f"concat('c', id div {months} % 2) as city", "'s' as state", "'A' as type", "id % 7 as transactions",
        f"cast(id % {months} as double) as dcoilwtico", "id % 3 = 0 as is_national_holiday")
    shared = marts.shared_facts(df)
    assert {g: f.size for g, f in shared.items() if g != "day"} == {"store": stores, "city": 2 * months}
    assert sum(f.size for f in shared.values()) < stores * months
    for name, build in marts.run_all(df).items():
        assert rows_of(build()) == rows_of(marts.MARTS[name](df)), name


def test_store_sums_know_no_period(wide):
    """Not even the period of the others: the store grain holds all dates together."""
    with pytest.raises(ValueError):
        marts.city_price_corr(marts.shared_facts(wide, catalog.PERIOD)["store"], period=catalog.PERIOD)


def test_store_days_need_rows(wide):
    with pytest.raises(ValueError):
        marts.average_ticket(marts.shared_facts(wide)["store"], grain="store_day")


def test_one_scan_of_the_wide_table(spark, wide, monkeypatch):
    """The rollup reads the wide table once; every mart reads only what the rollup stored."""
    from shopline.operators import rollup as module
    plans, kept = [], module.cut_lineage

    def spy(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return kept(df)

    monkeypatch.setattr(module, "cut_lineage", spy)
    some = marts.run_all(wide, catalog.PERIOD)
    assert len(plans) == 1 and plans[0].split("Initial Plan")[0].count("FileScan parquet") == 1
    place = wide._stored_at.rstrip("/").rsplit("/", 1)[1]
    for name, build in some.items():
        text = build()._jdf.queryExecution().optimizedPlan().toString()
        files = build()._jdf.inputFiles()
        assert all(place not in f for f in files), name
        assert "Expand" not in text


def test_empty_and_null_keys(spark):
    schema = "date date, store_nbr long, family string, sales double, onpromotion double, city string, state string, type string, transactions long, dcoilwtico double, is_national_holiday boolean"
    empty = spark.createDataFrame([], schema)
    for name, build in marts.run_all(empty).items():
        assert rows_of(build()) == rows_of(marts.MARTS[name](empty)), name
    import datetime as dt
    d = dt.date(2015, 3, 31)
    odd = [(d, None, None, 1.5, None, None, None, None, None, None, None), (None, 1, "F", None, 2.0, "c", "s", "A", 3, float("nan"), True),
           (d, 1, "F", float("nan"), 0.0, "c", "s", "A", 3, 7.25, True), (d, 1, "F", 1e30, 1.0, "c", "s", "B", 4, 7.5, False)]
    df = spark.createDataFrame(odd, schema)
    # Repeated keys: nan equals itself in repr only.
    for name, build in marts.run_all(df).items():
        assert repr(rows_of(build())) == repr(rows_of(marts.MARTS[name](df))), name


def test_grains_with_keys_of_one_name(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (1, "b", 3.0), (13, "a", 5.0), (None, "a", 7.0)], "k long, t string, v double")
    made, sizes = rollup(df, {"fine": {"k": F.col("k"), "t": F.col("t")}, "coarse": {"k": F.col("k") % 12}, "none": {}}, {"v": partial_sum("v"), "n": F.count(F.lit(1))})
    assert sizes == {"fine": 4, "coarse": 2, "none": 1}
    total = lambda d, *by: sorted(((*r[:-2], r[-2], r[-1]) for r in map(tuple, d.groupBy(*by).agg(exact_sum(Partial.of("v")), F.sum("n")).collect())), key=repr)
    assert total(made["fine"], "k", "t") == sorted([(1, "a", 2.0, 1), (1, "b", 3.0, 1), (13, "a", 5.0, 1), (None, "a", 7.0, 1)], key=repr)
    assert total(made["coarse"], "k") == sorted([(1, 10.0, 3), (None, 7.0, 1)], key=repr)
    assert total(made["none"]) == [(17.0, 4)]


def exact(values: list[float]) -> float:
    """The mean as exact_mean defines it, by rational numbers."""
    unit = 1 << 52
    whole = sum(math.floor(v) for v in values)
    part = sum(math.floor((v - math.floor(v)) * unit) for v in values)
    return (float(whole + part // unit) + float(part % unit) / unit) / len(values)


def test_mean_is_the_same_in_any_order(spark):
    rng = random.Random(9)
    values = [rng.uniform(1, 1e6) for _ in range(3000)] + [rng.uniform(-50, 50) for _ in range(500)] + [1e-30, -1e-30, 2.0**61, -(2.0**61), 0.1, 1 / 3]
    want = exact(values)
    assert abs(Fraction(want) - sum(map(Fraction, values)) / len(values)) < Fraction(1, 10**6)
    for seed in range(4):
        random.Random(seed).shuffle(values)
        df = spark.createDataFrame([(v, i % 5) for i, v in enumerate(values)] + [(None, 0)], "v double, g int").repartition(1 + 3 * seed)
        assert df.agg(exact_mean("v")).first()[0] == want
        parts = df.groupBy("g").agg(partial_mean("v").alias("p"))
        assert parts.agg(exact_mean(Partial.of("p"))).first()[0] == want


@pytest.mark.parametrize("values", [[], [None], [float("nan"), 1.0], [float("inf")], [1e300, 1.0], [-0.5], [2.0**62 * 4]])
def test_mean_of_odd_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.agg(exact_mean("v"), F.avg("v")).first()
    assert repr(got[0]) == repr(got[1])


def test_given_of_partial_sums(spark):
    df = spark.createDataFrame([(True, 1.0), (True, 2.0), (False, 5.0), (None, 9.0)], "f boolean, v double")
    parts = df.groupBy("f").agg(partial_sum("v").alias("p"))
    row = parts.agg(exact_avg(given(F.col("f"), Partial.of("p"))), exact_avg(given(~F.col("f"), Partial.of("p"))), exact_avg(Partial.of("p"))).first()
    assert tuple(row) == (1.5, 5.0, 17.0 / 4)


def test_price_means_under_random_partitioning(spark, wide):
    want = rows_of(marts.price_sales_corr(wide))
    for n in (1, 7):
        mixed = wide.repartition(n, F.rand(n))
        assert [r[:3] for r in rows_of(marts.price_sales_corr(mixed))] == [r[:3] for r in want]
