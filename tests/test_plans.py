"""Physical-plan checks: broadcast joins, pruned scans, pushdown, no Python."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_mod
from shopline.plans import catalog, marts
from shopline.sinks import writers

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_consolidation_broadcasts_every_dimension(spark):
    from shopline.operators import clean, consolidate
    observed: dict = {}
    tables = catalog.cleaned(spark, SF_DIR, observed)
    text = plan(consolidate.consolidate(tables, clean.observed_sizes(observed)))
    assert text.count("BroadcastHashJoin") >= 4
    assert "SortMergeJoin" not in text


@pytest.fixture(scope="module")
def stored(spark):
    import tempfile
    path = tempfile.mkdtemp(prefix="shopline-plan-") + "/consolidated"
    writers.write_consolidated(catalog.consolidated(spark, SF_DIR), path)
    return spark.read.parquet(path)


def test_mart_scan_is_pruned(spark, stored):
    text = plan(marts.sales_by_family(stored))
    schemas = [line for line in text.splitlines() if "ReadSchema" in line]
    assert schemas and all("struct<family:string,sales:double>" in s for s in schemas)


def test_period_filter_prunes_year_partitions(spark, stored):
    text = plan(marts.lag_corr(stored, period=catalog.PERIOD))
    assert "PartitionFilters: [isnotnull(year" in text
    assert "PushedFilters: [IsNotNull(date), GreaterThanOrEqual(date" in text


def test_ranking_has_no_global_row_number(spark, stored):
    # Ranks come from range partitions + per-partition offsets, not from a
    # row_number() window over all rows in one task.
    text = plan(marts.store_ranking(stored))
    assert "row_number" not in text.lower()


PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")


@pytest.mark.parametrize("name", sorted(marts.MARTS))
def test_no_python_in_mart_plans(spark, stored, name):
    text = plan(marts.MARTS[name](stored))
    assert not any(node in text for node in PYTHON_NODES)


@pytest.mark.parametrize("name", ["csv_repair", "profile_nulls", "impute_median", "consolidate"])
def test_no_python_in_source_and_clean_plans(spark, name):
    text = plan(entry_mod.queries()[name](spark, SF_DIR))
    assert not any(node in text for node in PYTHON_NODES)


def test_shuffle_join_path_when_dimensions_are_too_big(spark):
    """Where nothing is small enough to broadcast the joins are sort-merge joins
    (AQE splits skewed partitions there) and the result is the same."""
    from shopline.operators import consolidate as con
    tables = catalog.cleaned(spark, SF_DIR)
    expected = sorted(map(tuple, con.consolidate(tables).collect()), key=repr)
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        wide = con.consolidate(tables)
        text = plan(wide)
        assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
        assert sorted(map(tuple, wide.collect()), key=repr) == expected
    finally:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        if old["spark.sql.autoBroadcastJoinThreshold"] is not None:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old["spark.sql.autoBroadcastJoinThreshold"])


def test_only_sales_columns_are_shuffled_for_the_large_dimension(spark):
    """The join that shuffles the sales rows comes below the broadcast ones, which widen them."""
    from shopline.operators import clean, consolidate
    observed: dict = {}
    tables = catalog.cleaned(spark, SF_DIR, observed)
    sizes = {n: s for n, s in clean.observed_sizes(observed).items() if n != "transactions"}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        lines = plan(consolidate.consolidate(tables, sizes)).splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # A plan is printed from the root down.
    merge = [i for i, line in enumerate(lines) if "SortMergeJoin" in line and "store_nbr" in line]
    added = [i for i, line in enumerate(lines) if "BroadcastHashJoin" in line and "date" in line]
    assert len(merge) == 1 and added and max(added) < merge[0]


def test_raw_sales_are_scanned_once(spark):
    from shopline.sources import roles
    assert plan(roles.dirty_sales(spark, SF_DIR)).count("lineitem.parquet") == 1
