"""Invariants over the role tables."""

from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import functions as F

from shopline.operators import clean as cln
from shopline.plans import catalog, marts
from shopline.sinks import writers
from shopline.sources import roles

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark):
    path = tempfile.mkdtemp(prefix="shopline-inv-") + "/consolidated"
    writers.write_consolidated(catalog.consolidated(spark, SF_DIR), path)
    return spark.read.parquet(path)


def total(df):
    return round(sum(r["total_sales"] for r in df.collect()), 2)


def test_totals_agree_across_marts(stored):
    by_family = total(marts.sales_by_family(stored))
    assert by_family == total(marts.store_ranking(stored))
    assert by_family == total(marts.monthly_evolution(stored))
    assert by_family == total(marts.sales_by_city_state(stored))
    assert by_family == total(marts.holiday_impact(stored))


def test_shares_and_ranks(stored):
    pct = [r["pct_of_total"] for r in marts.sales_by_family(stored).collect()]
    assert sum(pct) == pytest.approx(100, abs=0.01 * len(pct))
    ranks = [r["ranking"] for r in marts.store_ranking(stored).collect()]
    assert ranks == list(range(1, len(ranks) + 1))


def test_correlations_are_bounded(stored):
    for mart in (marts.price_sales_corr, marts.transactions_vs_sales, marts.city_price_corr):
        for r in mart(stored).collect():
            assert r["corr"] is None or -1.0 <= r["corr"] <= 1.0


def test_interpolated_values_lie_between_neighbours(spark):
    raw = roles.prices(spark, SF_DIR).orderBy("date").collect()
    filled = {r["date"]: r["dcoilwtico"] for r in
              cln.interpolate(roles.prices(spark, SF_DIR), "date", "dcoilwtico").collect()}
    known = [(r["date"], r["dcoilwtico"]) for r in raw if r["dcoilwtico"] is not None]
    for i, r in enumerate(raw):
        if r["dcoilwtico"] is None:
            before = [v for d, v in known if d < r["date"]]
            after = [v for d, v in known if d > r["date"]]
            lo = min(before[-1:] + after[:1])
            hi = max(before[-1:] + after[:1])
            assert lo - 1e-9 <= filled[r["date"]] <= hi + 1e-9


def test_joins_keep_row_count(spark):
    tables = catalog.cleaned(spark, SF_DIR)
    assert catalog.con.consolidate(tables).count() == tables["train"].count()
    assert tables["train"].where(F.col("sales").isNull()).count() == 0
