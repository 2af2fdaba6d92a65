"""SparkSession construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults that hold from local[8] up to a large cluster.  Values that the
# cluster has set (spark-defaults / --conf), or that an open session has, win.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}
# Only where this library starts a local session itself.
LOCAL_CONF = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}


def get_session(master: str | None = None, app: str = "shopline",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Return the active session, or build one.

    ``extra`` and ``shuffle_partitions`` are the caller's own settings and are
    applied as given; :data:`DEFAULT_CONF` fills in only what nobody has set.
    """
    fresh = SparkSession.getActiveSession() is None
    builder = SparkSession.builder.appName(app)
    conf = dict(extra or {})
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            conf = {**LOCAL_CONF, **conf}
    if shuffle_partitions:
        conf.setdefault("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    if fresh:
        given = spark.sparkContext.getConf()
        for k, v in DEFAULT_CONF.items():
            if not given.contains(k):
                spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator to a shared file system; it is
    read from the session and never replaced.  Only when it is unset and the
    master is ``local[...]`` (tests) is a private folder created and registered;
    elsewhere executors would each write their own disk, so that is an error.
    Works without a
    SparkContext (Spark Connect) as long as the setting is present.
    """
    try:
        configured = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # noqa: BLE001  (static conf not exposed by this session)
        configured = None
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (Spark Connect: no SparkContext)
        sc = None
    if sc is None:
        if configured:
            return configured
        raise RuntimeError("spark.checkpoint.dir is not set for this session")
    current = sc.getCheckpointDir() or configured or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="shopline-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def cut_lineage(df):
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    Used where a table is read several times (statistics, then the join): it is
    computed once, survives executor loss (it lives on the shared file system,
    not on executor disks), replaces the upstream plan, and being columnar,
    a statistic over one column reads only that column.  Compressed by zstd,
    as the same bytes are written to the shared folder and read from it.
    """
    from pyspark.sql import types as T

    spark = df.sparkSession
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/shopline-tables/{uuid.uuid4().hex}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    _delete_at_exit(spark, path)
    # The schema is known: reading it back needs no footer-inference job.
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
    out = spark.read.schema(schema).parquet(path)
    out._stored_at = path
    return out


def write_scratch(spark: SparkSession, write) -> str:
    """Call ``write(path)`` with a new path in the shared folder; it is deleted when the driver ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/shopline-files/{uuid.uuid4().hex}"
    write(path)
    _delete_at_exit(spark, path)
    return path


def _filesystem(spark: SparkSession, path: str):
    """Hadoop path and file system of ``path``; None where the session has no JVM (Spark Connect)."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is None:
        return None, None
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _delete_at_exit(spark: SparkSession, path: str) -> None:
    """Intermediate tables go when the driver ends; results read from them may be lazy until then."""
    p, fs = _filesystem(spark, path)
    if fs is not None:
        fs.deleteOnExit(p)


def drop_stored(df) -> None:
    """Delete a table that :func:`cut_lineage` wrote, once nothing reads it any more."""
    path = getattr(df, "_stored_at", None) if df is not None else None
    if path:
        p, fs = _filesystem(df.sparkSession, path)
        if fs is not None:
            fs.delete(p, True)


def run_concurrently(tasks, workers: int | None = None) -> list:
    """Run independent driver-side calls (each submits its own Spark jobs) in
    threads and return their results in order.

    Spark schedules jobs from several threads side by side, so small
    independent jobs — statistics of different columns, cleaning of
    different tables, size checks of different dimensions — overlap instead
    of queueing behind each other.  The first exception is re-raised.
    """
    from concurrent.futures import ThreadPoolExecutor

    tasks = list(tasks)
    if len(tasks) <= 1 or workers == 1:
        return [t() for t in tasks]
    with ThreadPoolExecutor(max_workers=workers or min(len(tasks), 8)) as pool:
        futures = [pool.submit(t) for t in tasks]
        return [f.result() for f in futures]
