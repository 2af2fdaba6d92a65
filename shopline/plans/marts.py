"""The thirteen analytic marts over the consolidated table (M01-M14).

Each mart is a call of a generic operator with the retail column names; the
registry keeps the run order.  A mart reads either the consolidated table, of
which it needs 2-4 columns, or :class:`Facts` that :func:`shared_facts` has
summed in part: all thirteen marts roll up from three grains that one scan makes,
with the same result to the last digit (M14).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopline.functions.calendar import in_period
from shopline.functions.stats import Measure, Partial, exact_sum, partial_mean, partial_sum
from shopline.operators import aggregates as agg
from shopline.operators.rollup import rollup
from shopline.schemas import NATIONAL_FLAG

# Fixed values of the marts.
DEFAULT_PERIOD = ("2015-01-01", "2016-12-31")
MAX_LAG_MONTHS = 6
MIN_CITY_MONTHS = 3
WINDOW_DAYS = (3, 3)
DAY_LABELS = ("national_holiday", "normal_day")


@dataclass(frozen=True)
class Facts:
    """Sales rows, or groups of them with partial sums.

    ``rows`` names the row count of a group; ``period`` is the analysis period
    that a boolean column ``in_period`` tells, where dates are months (empty: there are
    no dates); ``size`` is the measured number of rows of ``df``.
    """

    df: DataFrame
    sales: Measure = "sales"
    price: Measure = "dcoilwtico"
    rows: str | None = None
    period: tuple[str, str] | None = None
    size: int | None = None

    @property
    def promoted(self):
        return F.col("promoted") if self.rows else F.col("onpromotion") > 0

    def inside(self, period: tuple[str, str]) -> Facts:
        if self.period is None:
            return replace(self, df=agg.restrict_period(self.df, "date", *period))
        if tuple(period) != tuple(self.period):
            raise ValueError(f"summed for the period {self.period}, not {period}")
        return replace(self, df=self.df.where("in_period"))


def _facts(df: DataFrame | Facts) -> Facts:
    return df if isinstance(df, Facts) else Facts(df)


def shared_facts(df: DataFrame, period: tuple[str, str] = DEFAULT_PERIOD) -> dict[str, Facts]:
    """Partial sums of the consolidated table at the three grains that all marts need, in one scan.

    ``day``: date, family, national flag, promotion - bounded by calendar and
    product range.  ``store``: store with its attributes, for all dates.  ``city``: city
    and month, split by the analysis period - bounded by calendar and cities.  No grain holds
    store and month together: with many stores those are about as many groups as
    rows, so they would be shuffled like rows.
    """
    grains, sizes = rollup(df, {
        "day": {"date": F.col("date"), "family": F.col("family"), NATIONAL_FLAG: F.col(NATIONAL_FLAG), "promoted": F.col("onpromotion") > 0},
        "store": {c: F.col(c) for c in ("store_nbr", "city", "state", "type")},
        "city": {"city": F.col("city"), "date": F.trunc("date", "month"), "in_period": in_period("date", *period)},
    }, {"sales": partial_sum("sales"), "dcoilwtico": partial_mean("dcoilwtico"), "transactions": F.sum("transactions"), "n_rows": F.count(F.lit(1))})
    made = {"sales": Partial.of("sales"), "price": Partial.of("dcoilwtico"), "rows": "n_rows"}
    periods = {"day": None, "store": (), "city": tuple(period)}
    return {g: Facts(grains[g], **made, period=p, size=sizes[g]) for g, p in periods.items()}


def sales_by_family(df: DataFrame | Facts) -> DataFrame:
    f = _facts(df)
    return (agg.share_of_total(f.df, "family", f.sales)
            .select("family", "total_sales", "avg_sales", "pct_of_total")
            .orderBy(F.col("total_sales").desc(), "family"))


def store_ranking(df: DataFrame | Facts) -> DataFrame:
    f = _facts(df)
    return (agg.ranked_totals(f.df, "store_nbr", f.sales, ["city", "state", "type"], at_most=f.size)
            .select("store_nbr", "total_sales", "city", "state", "type", "ranking")
            .orderBy("ranking"))


def sales_by_city_state(df: DataFrame | Facts) -> DataFrame:
    f = _facts(df)
    return (agg.group_summary(f.df, ["city", "state"], f.sales)
            .select("city", "state", "avg_sales", "total_sales")
            .orderBy(F.col("total_sales").desc(), "city", "state"))


def monthly_evolution(df: DataFrame | Facts) -> DataFrame:
    f = _facts(df)
    return agg.period_totals(f.df, "date", f.sales).orderBy("year_month")


def holiday_impact(df: DataFrame | Facts) -> DataFrame:
    f = _facts(df)
    return (agg.flag_summary(f.df, NATIONAL_FLAG, f.sales, DAY_LABELS, rows=f.rows)
            .select(NATIONAL_FLAG, "avg_sales", "total_sales", "n_rows", "day_type")
            .orderBy(NATIONAL_FLAG))


def holiday_window(df: DataFrame | Facts) -> DataFrame:
    f = _facts(df)
    before, after = WINDOW_DAYS
    return (agg.event_window(f.df, NATIONAL_FLAG, "date", "family", f.sales, before=before, after=after, store=f.rows is None)
            .select("offset", "family", "avg_sales")
            .orderBy("family", "offset"))


def holiday_sensitivity(df: DataFrame | Facts) -> DataFrame:
    f = _facts(df)
    return (agg.contrast_by_flag(f.df, "family", NATIONAL_FLAG, f.sales,
                                 when_true="avg_holiday", when_false="avg_normal",
                                 change="pct_change")
            .orderBy(F.col("pct_change").desc_nulls_first(), "family"))


def promotion_uplift(df: DataFrame | Facts) -> DataFrame:
    f = _facts(df)
    return (agg.contrast_by_flag(f.df, "family", f.promoted, f.sales,
                                 when_true="avg_promo", when_false="avg_no_promo",
                                 change="uplift_pct")
            .orderBy(F.col("uplift_pct").desc_nulls_first(), "family"))


def price_sales_corr(df: DataFrame | Facts) -> DataFrame:
    f = _facts(df)
    monthly = agg.monthly_series(f.df, "date", f.sales, f.price)
    return agg.with_global_corr(monthly, "total_sales", "avg_price").orderBy("year_month")


def lag_corr(df: DataFrame | Facts, period: tuple[str, str] = DEFAULT_PERIOD,
             max_lag: int = MAX_LAG_MONTHS) -> DataFrame:
    f = _facts(df).inside(period)
    monthly = agg.monthly_series(f.df, "date", f.sales, f.price)
    return agg.lag_corr(monthly, "year_month", "total_sales", "avg_price", max_lag).orderBy("lag_months")


def city_price_corr(df: DataFrame | Facts, period: tuple[str, str] = DEFAULT_PERIOD,
                    min_months: int = MIN_CITY_MONTHS) -> DataFrame:
    f = _facts(df).inside(period)
    monthly = agg.monthly_series(f.df, "date", f.sales, f.price, keys=["city"])
    return (agg.grouped_corr(monthly, "city", "total_sales", "avg_price", min_rows=min_months)
            .orderBy(F.col("corr").asc_nulls_first(), "city"))


def transactions_vs_sales(df: DataFrame | Facts) -> DataFrame:
    f = _facts(df)
    return (agg.totals_and_corr(f.df, "store_nbr", f.sales, "transactions")
            .orderBy(F.col("total_sales").desc(), "store_nbr"))


def average_ticket(df: DataFrame | Facts, grain: str = "row") -> DataFrame:
    """``grain="row"`` sums the store-day count on every row (as the source
    pipeline does); ``"store_day"`` counts each store-day once, for which the
    rows themselves are needed."""
    f = _facts(df)
    if grain != "row" and f.rows:
        raise ValueError("store-day counts can't be told from partial sums")
    g = None if grain == "row" else ["date"]
    return (agg.ratio_by_group(f.df, "store_nbr", f.sales, "transactions", grain=g)
            .select("store_nbr", "total_sales", "total_transactions", "avg_ticket")
            .orderBy(F.col("avg_ticket").desc(), "store_nbr"))


# Run order of the batch step (M14): output name -> mart.
MARTS: dict[str, Callable[[DataFrame | Facts], DataFrame]] = {
    "sales_by_family": sales_by_family,
    "store_ranking": store_ranking,
    "sales_by_city_state": sales_by_city_state,
    "monthly_evolution": monthly_evolution,
    "holiday_impact": holiday_impact,
    "holiday_window": holiday_window,
    "holiday_sensitivity": holiday_sensitivity,
    "promotion_uplift": promotion_uplift,
    "price_sales_corr": price_sales_corr,
    "lag_corr": lag_corr,
    "city_price_corr": city_price_corr,
    "transactions_vs_sales": transactions_vs_sales,
    "average_ticket": average_ticket,
}


# The grain that each mart rolls up from.
GRAINS = {name: "store" if name in ("store_ranking", "sales_by_city_state", "transactions_vs_sales", "average_ticket")
          else "city" if name == "city_price_corr" else "day" for name in MARTS}


def registry(period: tuple[str, str] = DEFAULT_PERIOD,
             max_lag: int = MAX_LAG_MONTHS) -> dict[str, Callable[[DataFrame], DataFrame]]:
    """:data:`MARTS` with the analysis period (and lag count) bound."""
    out = dict(MARTS)
    out["lag_corr"] = lambda df: lag_corr(df, period=period, max_lag=max_lag)
    out["city_price_corr"] = lambda df: city_price_corr(df, period=period)
    return out


def run_all(df: DataFrame, period: tuple[str, str] = DEFAULT_PERIOD,
            max_lag: int = MAX_LAG_MONTHS) -> dict[str, Callable[[], DataFrame]]:
    """All marts in run order from one scan of ``df`` (M14): the scan is done here,
    calling a mart reads the partial sums."""
    shared = shared_facts(df, period)
    return {name: (lambda fn=fn, of=shared[GRAINS[name]]: fn(of)) for name, fn in registry(period, max_lag).items()}


# -------------------------------------------------- report queries (§ dashboards)

def sales_by_store_type(df: DataFrame) -> DataFrame:
    """Total by store type, from the store ranking mart."""
    per_store = df.groupBy("type", "store_nbr").agg(exact_sum("sales").alias("_s"))
    return (per_store.groupBy("type")
            .agg(exact_sum("_s").alias("total_sales"),
                 F.count(F.lit(1)).alias("n_stores"))
            .orderBy(F.col("total_sales").desc(), "type"))


def top_families(df: DataFrame, k: int = 5) -> DataFrame:
    """The k families with the largest totals (a top-k report)."""
    return sales_by_family(df).limit(k)
