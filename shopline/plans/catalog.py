"""Registered queries: every operator of the inventory, run over the role tables.

Each entry is ``fn(spark, sf_dir) -> DataFrame`` and reads the whole given
tables (through :mod:`shopline.sources.roles`); the DuckDB oracles for the same
keys are in :mod:`shopline.plans.oracle_sql`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopline.operators import clean as cln
from shopline.operators import consolidate as con
from shopline.operators import profile as prf
from shopline.operators.distinct import duplicate_rows
from shopline.plans import marts
from shopline.schemas import INPUTS, SALES
from shopline.session import cut_lineage, drop_stored, run_concurrently, write_scratch
from shopline.sinks import versions, writers
from shopline.sources import csv as csvsrc
from shopline.sources import roles
from shopline.sources.parquet import read_marts

# The figure of each mart that the run over all marts reports.
MAIN_FIGURE = {"sales_by_family": "avg_sales", "store_ranking": "total_sales", "sales_by_city_state": "avg_sales", "monthly_evolution": "total_sales",
               "holiday_impact": "n_rows", "holiday_window": "avg_sales", "holiday_sensitivity": "avg_normal", "promotion_uplift": "avg_promo",
               "price_sales_corr": "avg_price", "lag_corr": "corr", "city_price_corr": "corr", "transactions_vs_sales": "total_transactions",
               "average_ticket": "avg_ticket"}

Query = Callable[[SparkSession, str], DataFrame]

# The analysis period of the lag / city correlations on the role tables.
PERIOD = roles.PERIOD


def cleaned(spark: SparkSession, sf_dir: str, observed: dict | None = None,
            names: list[str] | None = None) -> dict[str, DataFrame]:
    """The cleaned role tables, or only those named."""
    raw = {n: df for n, df in roles.raw_inputs(spark, sf_dir).items() if names is None or n in names}
    tables, _ = cln.clean_all(raw, parallel=len(raw), observed=observed)
    return tables


_WIDE: dict[tuple[str, str], DataFrame] = {}


def consolidated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide table: cleaned, joined and stored once per application and folder;
    every mart of a session reads that copy, which goes when the driver ends."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WIDE:
        observed: dict[str, dict] = {}
        tables = cleaned(spark, sf_dir, observed)
        _WIDE[key] = cut_lineage(con.consolidate(tables, sizes=cln.observed_sizes(observed)))
        for t in tables.values():
            drop_stored(t)
    return _WIDE[key]


def _mart(fn: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(consolidated(spark, sf_dir))
    run.__name__ = fn.__name__
    return run


def q_marts_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All thirteen marts from one scan (M14): per mart its rows, and the least and the largest of its main figure."""
    return _mart_summary(marts.run_all(consolidated(spark, sf_dir), PERIOD))


def _mart_summary(builds: dict[str, Callable[[], DataFrame]]) -> DataFrame:
    out = None
    for name, build in builds.items():
        figure = F.col(MAIN_FIGURE[name]).cast("double")
        one = build().agg(F.lit(name).alias("mart"), F.count(F.lit(1)).alias("n_rows"), F.min(figure).alias("lowest"), F.max(figure).alias("highest"))
        out = one if out is None else out.unionByName(one)
    return out


def q_lag_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.lag_corr(consolidated(spark, sf_dir), period=PERIOD)


def q_city_price_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.city_price_corr(consolidated(spark, sf_dir), period=PERIOD)


def q_average_ticket_store_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.average_ticket(consolidated(spark, sf_dir), grain="store_day")


# ------------------------------------------------------------ sources, profile

def q_csv_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales rows written as CSV text — families with embedded commas and
    quotes, rows with an even promotion count double-encoded — read back."""
    s = roles.sales(spark, sf_dir)
    odd = F.col("onpromotion") % 2 == 1
    s = s.withColumn("family", F.when(odd, F.concat(F.col("family"), F.lit(', "S'),
                                                     F.col("store_nbr").cast("string"), F.lit('"')))
                     .otherwise(F.col("family")))
    lines = csvsrc.render_csv_lines(s, wrap=F.col("onpromotion") % 3 == 0)
    header = spark.createDataFrame([(",".join(SALES.fieldNames()),)], "value string")
    return csvsrc.parse_csv_lines(header.unionByName(lines), SALES)


def q_csv_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales written as CSV files whose families run over several lines, with quotes and commas, some records
    double-encoded, read back in splits."""
    s = roles.sales(spark, sf_dir)
    long = F.concat(F.col("family"), F.lit('\n"'), F.col("store_nbr").cast("string"), F.lit('",\n\nend'))
    s = s.withColumn("family", F.when(F.col("onpromotion") % 2 == 1, long).otherwise(F.col("family")))
    return csvsrc.read_sales_csv(spark, _as_csv(spark, "train", s))


def _as_csv(spark: SparkSession, name: str, df: DataFrame) -> str:
    """The rows as CSV files in the scratch folder; sales with every third
    promotion count double-encoded."""
    if name == "train":
        lines = csvsrc.render_csv_lines(df, wrap=F.coalesce(F.col("onpromotion") % 3 == 0, F.lit(False)))
        header = spark.createDataFrame([(",".join(df.columns),)], "value string")
        return write_scratch(spark, lambda path: header.unionByName(lines).write.text(path))
    return write_scratch(spark, lambda path: df.write.option("header", True).csv(path))


def q_load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five inputs written as CSV files, loaded from them, and audited."""
    raw = roles.raw_inputs(spark, sf_dir)
    _, audit = csvsrc.load_all(spark, {n: _as_csv(spark, n, df) for n, df in raw.items()})
    return audit


def _csv_typed(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = _as_csv(spark, name, roles.raw_inputs(spark, sf_dir)[name])
        return csvsrc.read_csv_table(spark, path, INPUTS[name], name)
    return run


def q_profile_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prf.profile_tables(roles.raw_inputs(spark, sf_dir))["columns"]


def q_profile_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prf.profile_tables(roles.raw_inputs(spark, sf_dir))["tables"]


def q_profile_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prf.profile_tables(roles.raw_inputs(spark, sf_dir))["dates"]


# -------------------------------------------------------------------- cleaning

def q_dedupe_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cln.dedupe(roles.dirty_sales(spark, sf_dir))


def q_dedupe_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cln.dedupe(roles.dirty_sales(spark, sf_dir), method="fingerprint")


def q_duplicates_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and duplicate rows of every raw input, by fingerprint."""
    out = None
    for name, df in roles.raw_inputs(spark, sf_dir).items():
        one = duplicate_rows(df).select(F.lit(name).alias("table"), "rows", "duplicate_rows")
        out = one if out is None else out.unionByName(one)
    return out


def q_cast_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales with their dates as text, as an untyped feed has them."""
    text = roles.sales(spark, sf_dir).withColumn("date", F.col("date").cast("string"))
    return cln.cast_date(text, "date")


def q_impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = cut_lineage(cln.dedupe(roles.dirty_sales(spark, sf_dir)))
    out, _ = cln.impute(sales, ["sales", "onpromotion"])
    return out


def q_impute_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = cln.dedupe(roles.dirty_holidays(spark, sf_dir))
    out, _ = cln.impute(h, ["locale_name", "transferred"])
    return out


def q_interpolate_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cln.interpolate(roles.prices(spark, sf_dir), "date", "dcoilwtico", fill_edges=False)


def q_interpolate_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cln.interpolate(roles.prices(spark, sf_dir), "date", "dcoilwtico", fill_edges=True)


def q_interpolate_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices of every calendar day, weekends included."""
    return cln.interpolate(roles.prices(spark, sf_dir), "date", "dcoilwtico", calendar=True)


def q_interpolate_calendar_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions of every store on every day between its first and its last."""
    return cln.interpolate(roles.transactions(spark, sf_dir), "date", "transactions", keys=["store_nbr"], calendar=True)


def q_post_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls left in the columns that must have none after cleaning (CLN10)."""
    tables = cleaned(spark, sf_dir, names=["train", "oil"])
    out = None
    for name, column in (("train", "sales"), ("oil", "dcoilwtico")):
        cln.assert_no_nulls(tables[name], [column])
        nulls = cln.null_counts(tables[name].select(column)).select(
            F.lit(name).alias("table"), F.lit(column).alias("column"), F.col(column).alias("nulls"))
        out = nulls if out is None else out.unionByName(nulls)
    return out


def q_clean_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = roles.raw_inputs(spark, sf_dir)
    _, audit = cln.clean_all(raw, parallel=len(raw))
    return audit


# --------------------------------------------------------------- consolidation

def q_holiday_representative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return con.holidays_per_date(cleaned(spark, sf_dir, names=["holidays"])["holidays"]).drop("is_national_holiday")


def q_holiday_national_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return con.holidays_per_date(cleaned(spark, sf_dir, names=["holidays"])["holidays"]).select("date", "is_national_holiday")


def q_consolidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consolidated(spark, sf_dir)


def q_published_consolidated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide table published by year and read back from the published version
    (SNK1).  An earlier version with the later half of the years is replaced whole."""
    wide = consolidated(spark, sf_dir)

    def publish(root: str) -> None:
        middle = wide.agg(F.percentile_approx(F.year("date"), 0.5).alias("y"))
        for part in (wide.where(F.year("date") >= middle.scalar()), wide):
            with versions.new_version(spark, root) as folder:
                writers.write_consolidated(part, f"{folder}/consolidated", rebalance=False)

    root = write_scratch(spark, publish)
    return versions.read_published(spark, root, "consolidated").withColumn("year", F.col("year").cast("bigint"))


def q_published_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All marts published as one version and read back (SNK2, SRC8): the summary of ``marts_all``."""
    builds = marts.run_all(consolidated(spark, sf_dir), PERIOD)

    def publish(root: str) -> None:
        with versions.new_version(spark, root) as folder:
            run_concurrently([lambda n=n, b=b: writers.write_parquet(b(), f"{folder}/{n}") for n, b in builds.items()], workers=4)

    stored = read_marts(spark, versions.current(spark, write_scratch(spark, publish)), list(builds))
    return _mart_summary({name: (lambda df=df: df) for name, df in stored.items()})


def q_dimension_key_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that repeat in a raw dimension and would fan the left joins out."""
    raw = roles.raw_inputs(spark, sf_dir)
    checks = [con.key_violations(raw["stores"], ["store_nbr"], "stores"),
              con.key_violations(raw["transactions"], ["store_nbr", "date"], "transactions"),
              con.key_violations(raw["oil"], ["date"], "oil"),
              con.key_violations(raw["holidays"], ["date"], "holidays")]
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


def q_join_fanout_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = cleaned(spark, sf_dir)
    return con.fanout_audit(tables, con.consolidate(tables))


QUERIES: dict[str, Query] = {
    "csv_repair": q_csv_repair,
    "csv_multiline": q_csv_multiline,
    "csv_typed_stores": _csv_typed("stores"),
    "csv_typed_transactions": _csv_typed("transactions"),
    "csv_typed_prices": _csv_typed("oil"),
    "csv_typed_holidays": _csv_typed("holidays"),
    "cast_date": q_cast_date,
    "load_audit": q_load_audit,
    "profile_nulls": q_profile_nulls,
    "profile_duplicates": q_profile_duplicates,
    "profile_date_range": q_profile_date_range,
    "dedupe_rows": q_dedupe_rows,
    "dedupe_fingerprint": q_dedupe_fingerprint,
    "duplicates_fingerprint": q_duplicates_fingerprint,
    "impute_median": q_impute_median,
    "impute_mode": q_impute_mode,
    "interpolate_linear": q_interpolate_linear,
    "interpolate_edges": q_interpolate_edges,
    "interpolate_calendar": q_interpolate_calendar,
    "interpolate_calendar_stores": q_interpolate_calendar_stores,
    "post_conditions": q_post_conditions,
    "clean_audit": q_clean_audit,
    "holiday_representative": q_holiday_representative,
    "holiday_national_flag": q_holiday_national_flag,
    "consolidate": q_consolidate,
    "dimension_key_check": q_dimension_key_check,
    "join_fanout_audit": q_join_fanout_audit,
    "sales_by_family": _mart(marts.sales_by_family),
    "store_ranking": _mart(marts.store_ranking),
    "sales_by_city_state": _mart(marts.sales_by_city_state),
    "monthly_evolution": _mart(marts.monthly_evolution),
    "holiday_impact": _mart(marts.holiday_impact),
    "holiday_window": _mart(marts.holiday_window),
    "holiday_sensitivity": _mart(marts.holiday_sensitivity),
    "promotion_uplift": _mart(marts.promotion_uplift),
    "price_sales_corr": _mart(marts.price_sales_corr),
    "lag_corr": q_lag_corr,
    "city_price_corr": q_city_price_corr,
    "transactions_vs_sales": _mart(marts.transactions_vs_sales),
    "average_ticket": _mart(marts.average_ticket),
    "average_ticket_store_day": q_average_ticket_store_day,
    "sales_by_store_type": _mart(marts.sales_by_store_type),
    "top_families": _mart(marts.top_families),
    "marts_all": q_marts_all,
    "published_consolidated": q_published_consolidated,
    "published_marts": q_published_marts,
}
