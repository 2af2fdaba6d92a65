"""Sinks.  Executors write in parallel; nothing passes through the driver.

* :func:`write_parquet` — the consolidated table, partitioned by year so a
  period filter prunes whole folders (SNK1).
  A mart is one folder of the same writer (SNK2, M14); AQE merges the small
  final partitions of an aggregate, so a small mart is one file.
* :func:`write_jdbc`    — a table into a relational database (SNK3): each
  partition is one connection inserting in batches; ``overwrite`` replaces the
  table (an empty frame still creates it), ``append`` adds rows.  Connection
  data are parameters only.
* :func:`export_all`    — every table; a failing one is reported and the rest
  continue (SNK4).
* :func:`write_audit_json` — audit rows as JSON lines (SNK5).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shopline.session import run_concurrently

# Connections that one export holds open at most, whatever the partition count.
MAX_CONNECTIONS = 16
# Files that a task of a write without rebalancing holds open at most.
OPEN_FILES, OPEN_FILES_CONF = 32, "spark.sql.maxConcurrentOutputFileWriters"


def write_parquet(df: DataFrame, path: str, *, partition_by: list[str] | None = None,
                  mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_consolidated(df: DataFrame, path: str, date: str = "date", *, rebalance: bool = True) -> None:
    """Consolidated table partitioned by ``year`` (derived from ``date``).

    With ``rebalance`` a year's rows meet in a few tasks, and AQE splits a year that is large, so
    files number about size / target size instead of tasks x years, for one shuffle
    of the wide rows.  ``rebalance=False`` is for a stored table, whose splits are large
    already: each task writes its rows as they come, one file a year, with neither
    a shuffle nor a sort (the years beyond ``OPEN_FILES`` of a task are sorted).
    """
    rows = df.withColumn("year", F.year(date))
    if rebalance:
        rows = rows.hint("rebalance", "year")
    conf = df.sparkSession.conf
    before = conf.get(OPEN_FILES_CONF)
    if not rebalance and int(before) == 0:
        conf.set(OPEN_FILES_CONF, str(OPEN_FILES))
    try:
        # Static overwrite: a run replaces the whole table, also the years that it doesn't have.
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy("year").parquet(path))
    finally:
        conf.set(OPEN_FILES_CONF, before)


def write_jdbc(df: DataFrame, url: str, table: str, *, mode: str = "overwrite",
               properties: dict[str, str] | None = None, batch_size: int = 10_000,
               num_partitions: int = MAX_CONNECTIONS) -> None:
    writer = (df.write.format("jdbc").mode(mode)
              .option("url", url).option("dbtable", table)
              .option("batchsize", str(batch_size))
              .option("numPartitions", str(num_partitions)))
    for k, v in (properties or {}).items():
        writer = writer.option(k, v)
    writer.save()


def export_all(spark: SparkSession, tables: dict[str, Callable[[], DataFrame]],
               sink: Callable[[DataFrame, str], int | None], *, parallel: int = 1) -> DataFrame:
    """Export each table with ``sink(df, name)``; returns (table, status, rows,
    columns, error).

    Rows are those that the sink returns, or else counted while the table is
    written.  A table that fails to build or write is recorded as failed; the others are
    still exported (no error is swallowed: it is in the returned audit).
    ``parallel`` tables are written side by side (independent jobs).
    """
    def one(name: str, build: Callable[[], DataFrame]):
        columns = None
        try:
            df = build()
            columns = len(df.columns)
            seen = Observation(f"export_{name}_{uuid.uuid4().hex[:8]}")
            sent = sink(df.observe(seen, F.count(F.lit(1)).alias("rows")), name)
            return (name, "ok", int(seen.get["rows"]) if sent is None else sent, columns, None)
        except Exception as e:  # noqa: BLE001  (reported in the audit)
            return (name, "failed", None, columns, f"{type(e).__name__}: {e}")

    rows = run_concurrently([lambda n=n, b=b: one(n, b) for n, b in tables.items()], workers=parallel)
    return spark.createDataFrame(rows, "table string, status string, rows bigint, columns int, error string")


def write_audit_json(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)
