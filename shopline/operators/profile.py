"""Data-quality profile of a table (PRF1-6), one pass per table.

All row and null counts and date ranges of a table are one aggregate
(:func:`stat_columns`); the duplicate count is ``count - count(distinct rows)``
(a hash aggregate on all columns with map-side combine).  When the cleaning
step has already observed these numbers while it deduplicated and wrote the
table, the profile is built from them without reading the table again.
Results are long-form DataFrames, so profiles of many tables union into one
report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def stat_columns(df: DataFrame) -> list:
    """Aggregates ``_rows``, null count ``_n{i}`` of every column and
    ``_lo{i}`` / ``_hi{i}`` of every date column: every measure of a table,
    usable in ``agg`` or in ``observe``."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        aggs.append(F.coalesce(F.sum(c.isNull().cast("bigint")), F.lit(0)).alias(f"_n{i}"))
        if isinstance(f.dataType, T.DateType):
            aggs += [F.min(c).alias(f"_lo{i}"), F.max(c).alias(f"_hi{i}")]
    return aggs


def table_stats(df: DataFrame) -> DataFrame:
    """One row of :func:`stat_columns` — all measures of one table in one scan."""
    return df.agg(*stat_columns(df))


NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


def stats_frame(df: DataFrame, values: dict) -> DataFrame:
    """The one-row statistics of ``df`` from already known ``values``."""
    schema = table_stats(df).schema
    return df.sparkSession.createDataFrame([tuple(values[k] for k in schema.fieldNames())], schema)


def null_census(df: DataFrame, values: dict) -> dict[str, int]:
    """Column name → null count, from statistics values."""
    return {c: int(values[f"_n{i}"] or 0) for i, c in enumerate(df.columns)}


def column_profile(df: DataFrame, table: str, digits: int = 3,
                   stats: DataFrame | None = None) -> DataFrame:
    """(table, column, data_type, nulls, null_pct) per column (PRF2, PRF5).

    ``null_pct = round(100 * nulls / rows, digits)``, 0.0 for an empty table.
    """
    stats = stats if stats is not None else table_stats(df)
    cols = df.columns
    pairs = ", ".join(f"'{c}', '{df.schema[c].dataType.simpleString()}', _n{i}"
                      for i, c in enumerate(cols))
    long = stats.selectExpr("_rows", f"stack({len(cols)}, {pairs}) as (column, data_type, nulls)")
    nulls = F.col("nulls").cast("bigint")
    pct = F.when(F.col("_rows") > 0, F.round(nulls * 100.0 / F.col("_rows"), digits)).otherwise(F.lit(0.0))
    return long.select(F.lit(table).alias("table"), "column", "data_type",
                       nulls.alias("nulls"), pct.alias("null_pct"))


def table_profile(df: DataFrame, table: str, stats: DataFrame | None = None,
                  distinct_rows: DataFrame | int | None = None) -> DataFrame:
    """(table, rows, columns, duplicate_rows, total_nulls) (PRF1, PRF3, PRF6).

    ``distinct_rows`` may be an already deduplicated copy of ``df`` (the
    cleaning step's) or its known row count, so the distinct count does not
    shuffle the table again.
    """
    stats = stats if stats is not None else table_stats(df)
    if isinstance(distinct_rows, int):
        distinct = F.lit(distinct_rows).cast("bigint")
    else:
        src = distinct_rows if distinct_rows is not None else df.distinct()
        distinct = src.agg(F.count(F.lit(1))).scalar()
    return stats.select(F.lit(table).alias("table"), F.col("_rows").alias("rows"),
                        F.lit(len(df.columns)).alias("columns"),
                        (F.col("_rows") - distinct).alias("duplicate_rows"),
                        sum((F.col(f"_n{i}") for i in range(len(df.columns))), F.lit(0)).cast("bigint").alias("total_nulls"))


def date_ranges(df: DataFrame, table: str, stats: DataFrame | None = None) -> DataFrame | None:
    """(table, column, min_date, max_date) for every date column (PRF4)."""
    idx = [i for i, f in enumerate(df.schema.fields) if isinstance(f.dataType, T.DateType)]
    if not idx:
        return None
    stats = stats if stats is not None else table_stats(df)
    pairs = ", ".join(f"'{df.columns[i]}', _lo{i}, _hi{i}" for i in idx)
    return stats.selectExpr(f"'{table}' as table",
                            f"stack({len(idx)}, {pairs}) as (column, min_date, max_date)")


def profile_tables(tables: dict[str, DataFrame],
                   distinct: dict[str, DataFrame | int] | None = None,
                   known: dict[str, dict] | None = None) -> dict[str, DataFrame]:
    """The multi-table report (PRF6): ``columns``, ``tables`` and ``dates`` parts.

    Each table is scanned once for all its counts (the one-row statistics are
    materialized, so the three parts do not rescan it); tables whose
    statistics are ``known`` (observed by the cleaning step) are not scanned.
    """
    from shopline.session import run_concurrently

    distinct = distinct or {}
    known = dict(known or {})
    missing = [n for n in tables if n not in known]
    # One aggregate job per unknown table, run side by side.
    for n, values in zip(missing, run_concurrently(
            [lambda df=tables[n]: table_stats(df).collect()[0].asDict() for n in missing])):
        known[n] = values
    stats = {n: stats_frame(df, known[n]) for n, df in tables.items()}
    dates = [d for d in (date_ranges(df, n, stats[n]) for n, df in tables.items()) if d is not None]
    return {
        "columns": _union([column_profile(df, n, stats=stats[n]) for n, df in tables.items()]),
        "tables": _union([table_profile(df, n, stats[n], distinct.get(n)) for n, df in tables.items()]),
        "dates": _union(dates) if dates else None,
    }
