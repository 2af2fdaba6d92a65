"""Generic analytic aggregates; the thirteen marts are calls of these.

Every function takes and returns a DataFrame and names its inputs, so the same
operator serves any key / measure / flag.  A measure is a column or a
:class:`~shopline.functions.stats.Partial` of a pre-aggregate, whose row count
is then named too (``rows``).  Money sums are exact (decimal) and
means are exact sum / count, which makes every total independent of partition
count and summation order.  No operator here puts an unbounded set of rows in
one task: grand totals and global correlations are one-row aggregates used as
scalar subqueries, ranks come from :func:`global_position`, and the windows
that do run without a partition key run over calendar-bounded series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopline.functions.calendar import in_period, year_month
from shopline.functions.stats import Measure, exact_avg, exact_mean, exact_sum, given, safe_corr, safe_ratio
from shopline.operators.ordering import global_position
from shopline.session import cut_lineage

Keys = str | Sequence[str]

# Rows that one task may sort.
ONE_TASK_ROWS = 100_000


def _keys(k: Keys) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def share_of_total(df: DataFrame, key: Keys, measure: Measure, *, total: str = "total_sales",
                   mean: str | None = "avg_sales", pct: str = "pct_of_total",
                   digits: int = 2) -> DataFrame:
    """Per key: total, mean and share of the grand total in % (WIN1)."""
    aggs = [exact_sum(measure).alias(total)]
    if mean:
        aggs.append(exact_avg(measure).alias(mean))
    per_key = df.groupBy(*_keys(key)).agg(*aggs)
    # The subquery takes every column of the aggregate, so that it is the same
    # aggregate as the outer one and Spark computes it once.
    grand = per_key.agg(F.struct(exact_sum(total).alias("t"), *[F.max(c).alias(f"c{i}") for i, c in enumerate(per_key.columns)]))
    return per_key.withColumn(pct, F.round(safe_ratio(total, grand.scalar()["t"]) * 100, digits))


def ranked_totals(df: DataFrame, key: Keys, measure: Measure, attributes: Sequence[str] = (), *,
                  total: str = "total_sales", rank: str = "ranking", at_most: int | None = None) -> DataFrame:
    """Total per key with a 1..n rank, largest first, ties by key (WIN2).

    ``at_most``: a measured bound of the number of keys.  Up to ``ONE_TASK_ROWS``
    of them are ranked by one sorted window; beyond, or without a bound, by range
    partitions, which are stored.

    ``attributes`` are functionally dependent on ``key`` (store → city), so they
    are grouping columns, not ``first()`` picks.
    """
    keys = _keys(key)
    per_key = df.groupBy(*keys, *attributes).agg(exact_sum(measure).alias(total))
    order = [F.col(total).desc_nulls_last()] + [F.col(k).asc() for k in keys]
    if at_most is not None and at_most <= ONE_TASK_ROWS:
        return per_key.withColumn(rank, F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    ranked = global_position(per_key, order, name=rank)
    return ranked.withColumn(rank, F.col(rank) + 1)


def group_summary(df: DataFrame, keys: Keys, measure: Measure, *, mean: str = "avg_sales",
                  total: str = "total_sales", count: str | None = None, rows: str | None = None) -> DataFrame:
    """Mean, total (and row count) per key."""
    aggs = [exact_avg(measure).alias(mean), exact_sum(measure).alias(total)]
    if count:
        aggs.append((F.sum(rows) if rows else F.count(F.lit(1))).alias(count))
    return df.groupBy(*_keys(keys)).agg(*aggs)


def period_totals(df: DataFrame, date: str, measure: Measure, *, total: str = "total_sales") -> DataFrame:
    """Total per calendar month, with its year (DT1, DT2)."""
    return (df.groupBy(F.year(date).alias("year"), year_month(date).alias("year_month"))
            .agg(exact_sum(measure).alias(total)))


def flag_summary(df: DataFrame, flag: str, measure: Measure, labels: tuple[str, str], *,
                 label: str = "day_type", rows: str | None = None) -> DataFrame:
    """Per value of a boolean flag: mean, total, rows and a text label (EXP6)."""
    out = group_summary(df, flag, measure, count="n_rows", rows=rows)
    return out.withColumn(label, F.when(F.col(flag), F.lit(labels[0])).otherwise(F.lit(labels[1])))


def event_window(facts: DataFrame, flag: str, date: str, key: Keys, measure: Measure, *,
                 before: int = 3, after: int = 3, mean: str = "avg_sales", store: bool = True) -> DataFrame:
    """Mean daily total per (offset, key) around event dates (M06).

    Event dates are those with a row whose ``flag`` is true.  The facts are read
    once, for the daily totals, which are stored (so this starts a job; not with
    ``store=False``, for facts that are a small table already): dates and totals both come from them.  Each event date is expanded to ``before + after + 1`` dated offsets; a day
    near several events counts once per event.  Both join sides are small
    aggregates — daily totals (dates × keys, pre-aggregated before the join)
    and the expansion (distinct event dates × window length) — so the plain
    equi-join is cheap either way and AQE turns it into a broadcast join at
    run time when a side turns out small; no size probe is needed.
    """
    keys = _keys(key)
    daily = facts.groupBy(date, *keys).agg(exact_sum(measure).alias("_day"), F.bool_or(flag).alias("_flag"))
    daily = cut_lineage(daily) if store else daily
    window = (daily.where("_flag").select(F.col(date).alias("_event")).distinct()
              .select(F.explode(F.sequence(F.lit(-before), F.lit(after))).alias("offset"), "_event")
              .select("offset", F.date_add("_event", F.col("offset")).alias(date)))
    joined = daily.join(window, date, "inner")
    return joined.groupBy("offset", *keys).agg(exact_avg("_day").alias(mean))


def contrast_by_flag(df: DataFrame, key: Keys, flag: Column | str, measure: Measure, *,
                     when_true: str, when_false: str, change: str, digits: int = 2) -> DataFrame:
    """Mean per key with and without a flag and the % change (RSH1 + RSH2).

    A conditional aggregate replaces pivot + rename: both columns always exist
    (null when a side has no rows), and it is one hash aggregate.
    """
    f = F.col(flag) if isinstance(flag, str) else flag
    out = df.groupBy(*_keys(key)).agg(
        exact_avg(given(f, measure)).alias(when_true),
        exact_avg(given(~f, measure)).alias(when_false),
    )
    pct = safe_ratio(F.col(when_true) - F.col(when_false), when_false) * 100
    return out.withColumn(change, F.round(pct, digits))


def monthly_series(df: DataFrame, date: str, measure: Measure, price: Measure, *,
                   keys: Sequence[str] = (), total: str = "total_sales",
                   mean_price: str = "avg_price") -> DataFrame:
    """Per (keys, month): exact total of ``measure`` and row-weighted mean of ``price``."""
    return (df.groupBy(*keys, year_month(date).alias("year_month"))
            .agg(exact_sum(measure).alias(total), exact_mean(price).alias(mean_price)))


def with_global_corr(df: DataFrame, x: str, y: str, *, name: str = "corr",
                     digits: int = 4) -> DataFrame:
    """Attach Pearson r of (x, y) over all rows as a constant column (M09, M12)."""
    r = df.agg(F.round(safe_corr(x, y), digits))
    return df.withColumn(name, r.scalar())


def lag_corr(series: DataFrame, order: str, x: str, y: str, max_lag: int, *,
             lag: str = "lag_months", name: str = "corr", digits: int = 4) -> DataFrame:
    """Pearson r of x against y shifted by k rows, k = 0..max_lag (WIN3, JN10).

    ``series`` is one row per period (calendar-bounded), so its un-keyed
    ``lag`` window is small by construction.  All lags are one aggregate; an
    empty series gives an empty result.
    """
    w = Window.orderBy(order)
    shifted = series.select(x, *[F.lag(y, k).over(w).alias(f"_y{k}") for k in range(max_lag + 1)])
    one = shifted.agg(F.count(F.lit(1)).alias("_n"),
                      *[F.round(safe_corr(x, f"_y{k}"), digits).alias(f"_c{k}") for k in range(max_lag + 1)])
    pairs = ", ".join(f"{k}L, _c{k}" for k in range(max_lag + 1))
    return (one.where(F.col("_n") > 0)
            .selectExpr(f"stack({max_lag + 1}, {pairs}) as ({lag}, {name})"))


def grouped_corr(series: DataFrame, key: Keys, x: str, y: str, *, min_rows: int = 3,
                 name: str = "corr", digits: int = 4) -> DataFrame:
    """Pearson r per key over keys with at least ``min_rows`` rows (M11)."""
    return (series.groupBy(*_keys(key))
            .agg(F.count(F.lit(1)).alias("_n"), F.round(safe_corr(x, y), digits).alias(name))
            .where(F.col("_n") >= min_rows).drop("_n"))


def ratio_by_group(df: DataFrame, key: Keys, num: Measure, den: str, *,
                   num_total: str = "total_sales", den_total: str = "total_transactions",
                   ratio: str = "avg_ticket", grain: Sequence[str] | None = None) -> DataFrame:
    """Σnum / Σden per key over keys with Σden > 0 (M13).

    ``grain``: when ``den`` repeats on every row of a coarser grain (a
    store-day count copied onto each family row), pass that grain to sum each
    grain's value once; ``None`` sums ``den`` over rows.
    """
    keys = _keys(key)
    num_t = df.groupBy(*keys).agg(exact_sum(num).alias(num_total))
    if grain:
        den_t = (df.groupBy(*keys, *grain).agg(F.max(den).alias("_d"))
                 .groupBy(*keys).agg(F.sum("_d").alias(den_total)))
        out = num_t.join(den_t, keys, "left")
    else:
        out = df.groupBy(*keys).agg(exact_sum(num).alias(num_total), F.sum(den).alias(den_total))
    return (out.where(F.col(den_total) > 0)
            .withColumn(ratio, safe_ratio(num_total, den_total)))


def totals_and_corr(df: DataFrame, key: Keys, num: Measure, den: str, *,
                    num_total: str = "total_sales", den_total: str = "total_transactions",
                    name: str = "corr") -> DataFrame:
    """Totals per key (sum of nothing = 0) and r between them over keys (M12)."""
    per_key = df.groupBy(*_keys(key)).agg(
        exact_sum(num).alias(num_total),
        F.coalesce(F.sum(den), F.lit(0)).cast("bigint").alias(den_total))
    return with_global_corr(per_key, num_total, den_total, name=name)


def restrict_period(df: DataFrame, date: str, start: str, end: str) -> DataFrame:
    """Rows with ``start <= date <= end`` (DT4); pushed down to the scan.

    On a table stored partitioned by ``year`` the same bounds on ``year`` are
    added, so whole year folders outside the period are never listed or read.
    """
    out = df.where(in_period(date, start, end))
    if "year" in df.columns:
        out = out.where(F.col("year").between(int(str(start)[:4]), int(str(end)[:4])))
    return out
