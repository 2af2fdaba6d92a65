"""Cleaning: dedupe, date cast, imputation, interpolation, audit (CLN1-10).

Imputation values come to the driver, one value per column, and fill as
literals, so nothing downstream computes them again.  Medians and modes are the
distributed selections of :mod:`shopline.operators.ordering`.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopline.functions.sizing import bounded_broadcast, row_bytes
from shopline.operators.distinct import distinct_rows
from shopline.operators.ordering import exact_medians, most_frequent
from shopline.operators.profile import NUMERIC, null_census, stat_columns, table_stats
from shopline.session import cut_lineage, drop_stored, run_concurrently

# About so many rows of a series are sorted by one task.
TASK_ROWS = 500_000
# Size of what a series' slice in a range takes over its borders, without the keys.
EDGE_BYTES = 128


def dedupe(df: DataFrame, *, method: str = "rows") -> DataFrame:
    """Full-row distinct (CLN1).

    ``method="rows"``: a lazy hash aggregate on all columns, combined map-side.
    ``"fingerprint"``: only rows that may repeat are shuffled whole, for three
    reads of the table (see :mod:`shopline.operators.distinct`; starts jobs).
    """
    if method not in ("rows", "fingerprint"):
        raise ValueError(f"method must be 'rows' or 'fingerprint', not {method!r}")
    return df.dropDuplicates() if method == "rows" else distinct_rows(df)


def cast_date(df: DataFrame, column: str | None) -> DataFrame:
    """Cast ``column`` to date if present and not already a date (CLN2)."""
    if not column or column not in df.columns:
        return df
    if isinstance(df.schema[column].dataType, T.DateType):
        return df
    return df.withColumn(column, F.col(column).cast("date"))


def null_counts(df: DataFrame) -> DataFrame:
    """One row: null count of every column (one pass)."""
    return df.agg(*[F.coalesce(F.sum(F.col(f"`{c}`").isNull().cast("bigint")), F.lit(0))
                           .alias(c) for c in df.columns])


def strategy_for(dtype: T.DataType) -> str:
    """``median`` for signed numbers and floats, ``mode`` for everything else."""
    return "median" if isinstance(dtype, NUMERIC) else "mode"


def impute(df: DataFrame, columns: list[str] | None = None, *, median: str = "exact",
           accuracy: int = 10_000) -> tuple[DataFrame, DataFrame]:
    """Fill nulls: numeric → exact median, others → mode (CLN3-5).

    Returns the filled table and the imputation values as one row per column
    ``(column, strategy, value_num, value_text)``.  All medians share one
    distributed selection; each statistic comes back as a single value, so the
    fill is a literal and nothing downstream recomputes it.  Integer columns become double when a median is filled in, as a median
    of integers need not be an integer.  A column with no values stays null.
    ``median="approx"`` (opt-in) uses ``percentile_approx`` with ``accuracy``:
    one sketch-based aggregate, rank error at most ``rows / accuracy``.
    """
    if median not in ("exact", "approx"):
        raise ValueError(f"median must be 'exact' or 'approx', not {median!r}")
    cols = columns if columns is not None else df.columns

    signed = [c for c in cols if strategy_for(df.schema[c].dataType) == "median"]

    def medians() -> dict:
        if not signed:
            return {}
        if median == "approx":
            row = df.agg(*[F.percentile_approx(F.col(f"`{c}`").cast("double"), 0.5, accuracy).alias(f"m{i}")
                           for i, c in enumerate(signed)]).collect()[0]
            return {c: ("median", row[f"m{i}"]) for i, c in enumerate(signed)}
        return {r["column"]: ("median", r["median"]) for r in exact_medians(df, signed).collect()}

    def mode(c: str) -> dict:
        return {c: ("mode", most_frequent(df, c).collect()[0]["mode"])}

    # Independent small jobs run side by side: one for all medians, one per mode.
    found = {}
    for part in run_concurrently([medians, *[lambda c=c: mode(c) for c in cols if c not in signed]]):
        found.update(part)
    values = [found[c] for c in cols]
    fills, audit_rows = {}, []
    for c, (strategy, value) in zip(cols, values):
        dtype = df.schema[c].dataType
        if strategy == "median":
            fills[c] = F.coalesce(F.col(c).cast("double"), F.lit(value).cast("double"))
            audit_rows.append((c, "median", value, None))
        else:
            fills[c] = F.coalesce(F.col(c), F.lit(value).cast(dtype))
            audit_rows.append((c, "mode", None, None if value is None else _text(value)))
    out = df.withColumns(fills) if fills else df
    audit = df.sparkSession.createDataFrame(
        audit_rows, "column string, strategy string, value_num double, value_text string")
    return out, audit


def _text(value) -> str:
    """Text of an imputed value as Spark casts it to string."""
    if isinstance(value, bool):
        return "true" if value else "false"
    return str(value)


def with_calendar(df: DataFrame, date: str, keys: list[str] | None = None) -> DataFrame:
    """Add a row for each day that a series lacks between its first and its last (CLN6).

    Added rows hold the date and the keys, nulls elsewhere.  Only the gaps between
    a series' distinct days are written out as days; those days are found by a map-side combined
    aggregate, so a series with most of the rows is dealt over many tasks.  Rows without a date stay
    as they are; a series with no date at all gets no days; null keys are a
    series like any other; several rows of a day stay several.
    """
    if not isinstance(df.schema[date].dataType, T.DateType):
        raise TypeError(f"{date} must be a date column")
    keys = keys or []
    series = [F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)]
    day = F.col(f"`{date}`")
    # Distinct before the window: what meets in a task is bounded by the calendar, not by the rows of a day.
    known = df.filter(day.isNotNull()).select(*series, day.alias("__day")).distinct()
    names = [f"__k{i}" for i in range(len(keys))]
    gaps = known.withColumn("__next", F.lead("__day").over(Window.partitionBy(*names).orderBy("__day")))
    gaps = gaps.filter(F.datediff("__next", "__day") > 1)
    missing = gaps.select(*names, F.explode(F.sequence(F.date_add("__day", 1), F.date_sub("__next", 1))).alias("__day"))
    made = {date: F.col("__day"), **{k: F.col(f"__k{i}") for i, k in enumerate(keys)}}
    return df.union(missing.select(*[made.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in df.schema.fields]))


def interpolate(df: DataFrame, order: str, value: str, *, by: str = "position",
                keys: list[str] | None = None, fill_edges: bool = True, calendar: bool = False) -> DataFrame:
    """Linear interpolation of interior nulls, then edge fill (CLN6, CLN7).

    ``by="position"``: the straight line runs over row positions (a weekend gap
    is no extra step); ``by="time"``: over days between the dates.  Edges:
    a leading null takes the next value, a trailing null the previous one.
    ``keys`` interpolate each series separately.  ``calendar`` first adds the days
    that a series lacks (:func:`with_calendar`), so every day gets a value.

    No series has to fit in one task: rows are stored, range-partitioned in order and
    stored again (so this starts jobs), neighbours are sought within a partition in
    linear time, and a table of one row per series and partition carries the
    nearest values and the row offset over the borders.  More than ``TASK_ROWS``
    rows are dealt over so many tasks that each has about that number.
    """
    if by not in ("position", "time"):
        raise ValueError(f"by must be 'position' or 'time', not {by!r}")
    keys = keys or []
    if calendar:
        df = with_calendar(df, order, keys)
    # The value breaks ties between rows of one date, so the result is
    # deterministic even when a feed holds two prices for a day.
    sort = [F.col(order).asc(), F.col(value).asc_nulls_last()]
    turned = [F.col(order).desc(), F.col(value).desc_nulls_first()]
    v = F.col(value).cast("double")
    # Stored and counted first: the bounds of the ranges are sampled from it, and its rows, not
    # the bytes of a shuffle that packs such rows very well, say how many tasks share them.
    seen = Observation(f"series_{uuid.uuid4().hex[:8]}")
    source = cut_lineage(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    rows = int(seen.get["rows"])
    dealt = [max(rows // TASK_ROWS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))] if rows > TASK_ROWS else []
    staged = cut_lineage(source.repartitionByRange(*dealt, *keys, *sort).withColumn("_pid", F.spark_partition_id()))
    drop_stored(source)
    if dealt:
        groups = staged.select(*keys, "_pid").distinct()
        staged = staged.repartition(*dealt, *keys, "_pid")
    part = Window.partitionBy(*keys, "_pid")
    staged = staged.withColumn("_row", F.row_number().over(part.orderBy(*sort)).cast("bigint"))
    known = F.when(v.isNotNull(), F.struct(v.alias("v"), F.col("_row").alias("row"), F.col(order).alias("at")))
    staged = staged.withColumn("_known", known)
    # Per series and partition: rows, and the first and last known value.
    edges = staged.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_pid").alias("_p")).agg(
        F.count(F.lit(1)).alias("_n"), F.min_by("_known", F.when(v.isNotNull(), F.col("_row"))).alias("_first"),
        F.max_by("_known", F.when(v.isNotNull(), F.col("_row"))).alias("_last"))
    series = Window.partitionBy(*[f"_k{i}" for i in range(len(keys))])
    earlier = series.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    later = series.orderBy(F.col("_p").desc()).rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    shift = lambda e: F.when(F.col(e).isNotNull(), F.struct(
        F.col(f"{e}.v").alias("v"), (F.col(f"{e}.row") + F.col("_before")).alias("row"), F.col(f"{e}.at").alias("at")))
    edges = edges.withColumns({"_first": shift("_first"), "_last": shift("_last")})
    edges = edges.withColumns({"_into": F.last("_last", ignorenulls=True).over(earlier),
                               "_outof": F.last("_first", ignorenulls=True).over(later)})
    match = (F.col("_pid") == F.col("_p"))
    for i, k in enumerate(keys):
        match = match & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    edges = edges.select(*[f"_k{i}" for i in range(len(keys))], "_p", "_before", "_into", "_outof")
    if dealt:
        n, size = groups.agg(F.count(F.lit(1)), F.sum(row_bytes(groups))).first()
        edges = bounded_broadcast(edges, (n, size + n * EDGE_BYTES))
    # Running windows in both directions: each looks back from its row only.
    near = staged.withColumns({
        "_lk": F.last("_known", ignorenulls=True).over(part.orderBy(*sort).rowsBetween(Window.unboundedPreceding, 0)),
        "_nk": F.last("_known", ignorenulls=True).over(part.orderBy(*turned).rowsBetween(Window.unboundedPreceding, 0)),
    }).join(edges, match, "left")
    place = lambda k: F.when(F.col(k).isNotNull(), F.struct(
        F.col(f"{k}.v").alias("v"), (F.col(f"{k}.row") + F.col("_before")).alias("row"), F.col(f"{k}.at").alias("at")))
    near = near.withColumns({"_lk": F.coalesce(place("_lk"), "_into"), "_nk": F.coalesce(place("_nk"), "_outof"),
                             "_row": F.col("_row") + F.col("_before")})
    if by == "position":
        here, left, right = F.col("_row"), F.col("_lk.row"), F.col("_nk.row")
    else:
        days = lambda c: F.datediff(c, F.lit("1970-01-01").cast("date"))
        here, left, right = days(F.col(order)), days(F.col("_lk.at")), days(F.col("_nk.at"))
    lv, nv = F.col("_lk.v"), F.col("_nk.v")
    step = (here - left).cast("double")
    line = lv + (nv - lv) * step / (right - left).cast("double")
    filled = F.when(v.isNotNull(), v).when(lv.isNotNull() & nv.isNotNull(), line)
    if fill_edges:
        filled = F.coalesce(filled, lv, nv)
    return near.withColumn(value, filled).select(*df.columns)


@dataclass
class CleanSpec:
    """How one table is cleaned (CLN9).

    """
    date: str | None = "date"
    interpolate: str | None = None          # value column to interpolate over ``date``
    impute: bool = True
    series_keys: list[str] = field(default_factory=list)
    calendar: bool = False                  # add the days that a series lacks


# Per-table dispatch of the batch run.
SPECS = {
    "train": CleanSpec(),
    "stores": CleanSpec(date=None),
    "transactions": CleanSpec(),
    "oil": CleanSpec(interpolate="dcoilwtico", impute=False),
    "holidays": CleanSpec(),
}


def clean_table(name: str, df: DataFrame, spec: CleanSpec, *, materialize: bool = True,
                observed: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """Clean one table; returns (clean table, audit rows) (CLN8).

    With ``materialize`` (the batch run) the table is read once: that pass
    observes the raw statistics (rows, nulls per column, date ranges — the
    audit's "nulls before" and the profile's numbers), deduplicates, observes
    the rows kept and writes the result to the checkpoint folder.  Medians,
    modes, interpolation and the later join all read that copy.  Imputation
    values come back as one value per column and fill as literals, so the
    audit is built from known numbers without another job.  ``observed``
    receives the statistics (``_rows``, ``_n{i}``, ``_lo{i}``, ``_hi{i}``,
    ``_kept``, ``_kept_bytes``) for the profile and for the
    broadcast decisions of the joins.  Without ``materialize`` the plan stays lazy
    and the statistics are one aggregate job.
    """
    spark = df.sparkSession
    if materialize:
        tag = uuid.uuid4().hex[:8]
        raw_obs, kept_obs = Observation(f"raw_{name}_{tag}"), Observation(f"kept_{name}_{tag}")
        deduped = dedupe(df.observe(raw_obs, *stat_columns(df)))
        deduped = cast_date(deduped, spec.date)
        deduped = deduped.observe(kept_obs, F.count(F.lit(1)).alias("_kept"),
                                  F.coalesce(F.sum(row_bytes(deduped)), F.lit(0)).alias("_kept_bytes"))
        out = cut_lineage(deduped)
        stats = dict(raw_obs.get)
        stats.update(kept_obs.get)
    else:
        stats = table_stats(df).collect()[0].asDict()
        out = cast_date(dedupe(df), spec.date)
        stats["_kept"] = out.count()
    nulls = null_census(df, stats)
    imputed: list[tuple] = []
    if spec.interpolate:
        out = interpolate(out, spec.date, spec.interpolate, keys=spec.series_keys, calendar=spec.calendar)
        imputed = [(spec.interpolate, "linear_interpolation+edge_fill", None, None)]
    elif spec.impute:
        with_nulls = [c for c in df.columns if nulls[c]]
        if with_nulls:
            out, values = impute(out, with_nulls)
            imputed = [tuple(r) for r in values.collect()]
    if observed is not None:
        observed.update(stats)
    return out, clean_audit(spark, name, stats, nulls, imputed)


AUDIT_SCHEMA = ("table string, column string, rows_before bigint, rows_after bigint, "
                "duplicates_removed bigint, nulls_before bigint, strategy string, "
                "value_num double, value_text string")


def clean_audit(spark, name: str, stats: dict, nulls: dict[str, int],
                imputed: list[tuple]) -> DataFrame:
    """Rows (table, column, rows_before, rows_after, duplicates_removed,
    nulls_before, strategy, value_num, value_text); one row per column with
    nulls before cleaning."""
    how = {c: (st, num, text) for c, st, num, text in imputed}
    before, after = int(stats["_rows"]), int(stats["_kept"])
    rows = [(name, c, before, after, before - after, n, *how.get(c, (None, None, None)))
            for c, n in nulls.items() if n > 0]
    return spark.createDataFrame(rows, AUDIT_SCHEMA)


def clean_all(tables: dict[str, DataFrame], specs: dict[str, CleanSpec] | None = None, *,
              materialize: bool = True, observed: dict[str, dict] | None = None,
              parallel: int = 1) -> tuple[dict[str, DataFrame], DataFrame]:
    """Clean every table by its spec; audits are unioned.  ``observed``
    receives each table's statistics (see :func:`clean_table`); ``parallel``
    tables are cleaned side by side (their jobs are independent)."""
    specs = specs or SPECS
    names = list(tables)
    seen = {n: {} for n in names}
    results = run_concurrently(
        [lambda n=n: clean_table(n, tables[n], specs.get(n, CleanSpec()),
                                 materialize=materialize, observed=seen[n]) for n in names],
        workers=parallel)
    out, audits = {}, []
    for n, (table, audit) in zip(names, results):
        out[n] = table
        audits.append(audit)
        if observed is not None:
            observed[n] = seen[n]
    audit = audits[0]
    for a in audits[1:]:
        audit = audit.unionByName(a)
    return out, audit


def observed_sizes(observed: dict[str, dict]) -> dict[str, tuple[int, int]]:
    """``(rows, bytes)`` upper bounds of each cleaned table, from the clean
    step's observations (padded by 8 bytes a row for derived columns)."""
    return {n: (int(v["_kept"]), int(v["_kept_bytes"]) + 8 * int(v["_kept"]))
            for n, v in observed.items() if "_kept_bytes" in v}


def assert_no_nulls(df: DataFrame, columns: list[str]) -> None:
    """Post-condition (CLN10): raise if any of ``columns`` still holds nulls."""
    counts = null_counts(df.select(*columns)).collect()[0].asDict()
    bad = {c: n for c, n in counts.items() if n}
    if bad:
        raise ValueError(f"nulls remain after cleaning: {bad}")
