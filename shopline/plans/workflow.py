"""The batch run: load → profile → clean → consolidate → marts → export.

One SparkSession and one lazy plan per step.  The consolidated table is
written once as Parquet (partitioned by year); one scan of it makes partial sums
at three grains, from which all marts roll up; nothing is cached in executor memory, so a lost
executor only costs the recomputation of its own tasks, and the written table
is the lineage cut between the join step and the thirteen aggregates.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shopline.operators import clean as cln
from shopline.operators import consolidate as con
from shopline.operators import profile as prf
from shopline.plans import marts as mrt
from shopline.sinks import staged, versions, writers
from shopline.session import run_concurrently
from shopline.sources.parquet import read_marts

# Marts that are made at the same time.
PARALLEL_MARTS = 4


@dataclass
class RunResult:
    consolidated_path: str
    mart_paths: dict[str, str]
    audits: dict[str, DataFrame]
    seconds: dict[str, float] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)


def run(spark: SparkSession, inputs: dict[str, DataFrame], out_dir: str, *,
        marts: dict[str, Callable[[DataFrame], DataFrame]] | None = None,
        period: tuple[str, str] | None = None, profile: bool = True) -> RunResult:
    """Run every step over ``inputs`` (the five loaded tables) into ``out_dir``.

    ``period`` is the analysis period of the lag / city correlations (default:
    the marts' own); ``marts`` replaces the whole registry by functions of the
    consolidated table.
    """
    seconds: dict[str, float] = {}
    audits: dict[str, DataFrame] = {}

    def timed(step: str, fn):
        t0 = time.perf_counter()
        out = fn()
        seconds[step] = round(time.perf_counter() - t0, 3)
        return out

    observed: dict[str, dict] = {}
    columns: dict[str, int] = {f"load_{n}": len(df.columns) for n, df in inputs.items()}
    consolidated_path = f"{out_dir}/consolidated"

    def clean_and_consolidate():
        tables, clean_audit = cln.clean_all(inputs, observed=observed, parallel=len(inputs))
        cln.assert_no_nulls(tables["oil"], ["dcoilwtico"])  # CLN10: an all-null series can't be filled
        wide = con.consolidate(tables, sizes=cln.observed_sizes(observed))
        columns["consolidated"] = len(wide.columns)
        # Row count and the post-condition (CLN10: no null sales) are observed
        # while the table is written, not by another scan.
        seen = Observation(f"wide_{uuid.uuid4().hex[:8]}")
        wide = wide.observe(seen, F.count(F.lit(1)).alias("rows"),
                            F.sum(F.col("sales").isNull().cast("bigint")).alias("null_sales"))
        writers.write_consolidated(wide, consolidated_path)
        return clean_audit, seen.get

    clean_audit, wide_stats = timed("clean_consolidate", clean_and_consolidate)
    if wide_stats["null_sales"]:
        raise ValueError(f"nulls remain in sales after cleaning: {wide_stats['null_sales']}")
    audits["clean"] = clean_audit
    rows = {"consolidated": int(wide_stats["rows"])}
    rows.update({f"load_{n}": int(v["_rows"]) for n, v in observed.items()})

    if profile:
        # Profile of the raw inputs from the statistics observed while cleaning.
        kept = {n: int(v["_kept"]) for n, v in observed.items()}
        report = prf.profile_tables(inputs, distinct=kept, known=observed)
        for part, df in report.items():
            if df is not None:
                path = f"{out_dir}/audit/profile_{part}"
                timed(f"profile_{part}", lambda df=df, path=path: writers.write_audit_json(df, path))
                audits[f"profile_{part}"] = spark.read.json(path)
    timed("clean_audit", lambda: writers.write_audit_json(clean_audit, f"{out_dir}/audit/clean"))

    stored = spark.read.parquet(consolidated_path)
    if marts:
        builds = {name: (lambda fn=fn: fn(stored)) for name, fn in marts.items()}
    else:
        # One scan of the wide table makes the partial sums that all marts roll up from.
        builds = timed("rollup", lambda: mrt.run_all(stored, period or mrt.DEFAULT_PERIOD))
    def write(name: str, build: Callable[[], DataFrame]) -> None:
        path = mart_paths[name] = f"{out_dir}/marts/{name}"
        seen = Observation(f"{name}_{uuid.uuid4().hex[:8]}")

        def one():
            mart = build()
            columns[name] = len(mart.columns)
            writers.write_parquet(mart.observe(seen, F.count(F.lit(1)).alias("rows")), path)

        timed(name, one)
        rows[name] = int(seen.get["rows"])

    # Independent small jobs side by side; a mart's seconds are its own, those of "marts" the clock's.
    mart_paths = dict.fromkeys(builds, "")
    timed("marts", lambda: run_concurrently([lambda n=n, b=b: write(n, b) for n, b in builds.items()], workers=PARALLEL_MARTS))

    # Step metrics (SNK5): rows, columns and seconds per step, as JSON lines.
    steps = sorted(set(rows) | set(seconds))
    metrics = spark.createDataFrame([(s, rows.get(s), columns.get(s), seconds.get(s)) for s in steps],
                                    "step string, rows bigint, columns int, seconds double")
    writers.write_audit_json(metrics, f"{out_dir}/audit/steps")
    audits["steps"] = metrics
    return RunResult(consolidated_path, mart_paths, audits, seconds, rows)


def run_published(spark: SparkSession, inputs: dict[str, DataFrame], root: str, **options) -> RunResult:
    """:func:`run` into a new version below ``root``, published when every step is
    done (:mod:`shopline.sinks.versions`): readers of ``root`` see all tables of
    one run, and those of the run before if this one fails."""
    with versions.new_version(spark, root) as folder:
        return run(spark, inputs, folder, **options)


def export(spark: SparkSession, result: RunResult, url: str, *,
           properties: dict[str, str] | None = None, num_partitions: int = writers.MAX_CONNECTIONS,
           parallel: int = 4) -> DataFrame:
    """Export the consolidated table and every mart over JDBC (SNK3, SNK4).

    Tables are re-read from the written Parquet; each is written by the
    executors in parallel partitions, and replaced as a whole where the database
    is known to allow it (:mod:`shopline.sinks.staged`), else in place.  Returns the (table, status, rows, columns,
    error) audit, which is also written beside the run's other audits.
    """
    folder = {p.rsplit("/", 1)[0] for p in result.mart_paths.values()}
    builds = {"consolidated": lambda: spark.read.parquet(result.consolidated_path)}
    if len(folder) == 1:
        stored = read_marts(spark, folder.pop(), list(result.mart_paths))
        builds.update({n: (lambda df=df: df) for n, df in stored.items()})
    else:
        builds.update({n: (lambda p=p: spark.read.parquet(p)) for n, p in result.mart_paths.items()})
    def sink(df: DataFrame, name: str) -> int:
        options = {"properties": properties, "num_partitions": num_partitions}
        if staged.database(url) in staged.RENAME:
            return staged.replace_table(df, url, name.upper(), **options)
        writers.write_jdbc(df, url, name.upper(), **options)
        return df.count()

    audit = writers.export_all(spark, builds, sink, parallel=parallel)
    writers.write_audit_json(audit, f"{result.consolidated_path.rsplit('/', 1)[0]}/audit/export")
    return audit
