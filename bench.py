"""Benchmark: the whole batch run at one scale factor; prints one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8).  Untimed setup renders the raw inputs (sales with duplicates,
blanks and double-encoded lines; stores; transactions; prices; holidays) as
CSV files into a fresh scratch folder.  Timed steps then mirror the reference
pipeline: load (CSV with repair), profile, clean + consolidate (written as
Parquet), each of the thirteen marts (written), and the export of every table
to an embedded in-memory Derby database through JDBC.  ``BENCH_EVENT_LOG=1``
writes Spark's event log into the scratch folder for stage / task times.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from shopline.operators import clean as cln  # noqa: E402
from shopline.operators import consolidate as con  # noqa: E402
from shopline.operators import profile as prf  # noqa: E402
from shopline.plans import marts as mrt, workflow  # noqa: E402
from shopline.session import get_session, run_concurrently  # noqa: E402
from shopline.sinks import writers  # noqa: E402
from shopline.sources import csv as csvsrc  # noqa: E402
from shopline.sources import roles  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="shopline-bench-")
    extra = {"spark.driver.memory": "16g",
             "spark.checkpoint.dir": f"file://{scratch}/checkpoint"}
    if os.environ.get("BENCH_EVENT_LOG"):
        # Stage and task times for offline reading (no UI, no server).
        os.makedirs(f"{scratch}/events", exist_ok=True)
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{scratch}/events"})
    spark = get_session(f"local[{cpus}]", app="shopline-bench", shuffle_partitions=cpus * 2, extra=extra)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]

    # ---- untimed setup: raw CSV inputs rendered from the given tables
    raw = roles.raw_inputs(spark, sf_dir)
    paths = {}
    for name, df in raw.items():
        path = f"{scratch}/csv/{name}"
        wrap = (F.col("onpromotion") % 3 == 0) if name == "train" else None
        lines = csvsrc.render_csv_lines(df, wrap=wrap)
        header = spark.createDataFrame([(",".join(df.columns),)], "value string")
        header.unionByName(lines).coalesce(max(1, cpus)).write.mode("overwrite").text(path)
        paths[name] = path
    # The other tables are read by the plain CSV reader, which checks every file's header.
    for name, df in raw.items():
        if name != "train":
            path = f"{scratch}/csv1/{name}"
            df.write.mode("overwrite").option("header", True).csv(path)
            paths[name] = path

    q: dict[str, float] = {}

    def timed(step, fn):
        t0 = time.perf_counter()
        out = fn()
        q[step] = round(time.perf_counter() - t0, 3)
        return out

    # ---- load: parse (and repair) every column of every file; rows, nulls and repairs
    tables, load_audit = csvsrc.load_all(spark, paths)
    timed("load", lambda: load_audit.collect())

    # ---- clean (dedupe, impute, interpolate; each table written once), then
    # consolidate (four joins), written as Parquet partitioned by year
    out = f"{scratch}/out"
    observed: dict[str, dict] = {}

    def clean():
        return cln.clean_all(tables, observed=observed, parallel=len(tables))
    cleaned, clean_audit = timed("clean", clean)

    def consolidate():
        wide = con.consolidate(cleaned, sizes=cln.observed_sizes(observed))
        writers.write_consolidated(wide, f"{out}/consolidated")
    timed("consolidate", consolidate)

    # ---- profile: nulls, types, duplicates, date ranges of the five raw tables,
    # from the statistics the clean step observed while it read each table
    def profile():
        kept = {n: int(v["_kept"]) for n, v in observed.items()}
        report = prf.profile_tables(tables, distinct=kept, known=observed)
        parts = [d for d in report.values() if d is not None] + [clean_audit]
        return run_concurrently([lambda d=d: d.collect() for d in parts])
    timed("profile", profile)

    stored = spark.read.parquet(f"{out}/consolidated")
    # The role data spans 1995-2001: its analysis period is roles.PERIOD.
    # One scan makes the partial sums ("rollup"), from which all marts are made.
    builds = timed("rollup", lambda: mrt.run_all(stored, roles.PERIOD))
    # Independent small jobs run side by side, as in the batch run: "marts" is the clock's
    # time of all thirteen, "mart_seconds" has each one's own, which overlap.
    marts: dict[str, float] = {}

    def mart(name, build):
        t0 = time.perf_counter()
        writers.write_parquet(build(), f"{out}/marts/{name}")
        marts[name] = round(time.perf_counter() - t0, 3)

    timed("marts", lambda: run_concurrently([lambda n=n, b=b: mart(n, b) for n, b in builds.items()], workers=workflow.PARALLEL_MARTS))

    # ---- export: consolidated table and every mart to embedded Derby (JDBC)
    url = "jdbc:derby:memory:shopline_bench;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}

    def export():
        builds = {"consolidated": lambda: spark.read.parquet(f"{out}/consolidated")}
        builds.update({n: (lambda n=n: spark.read.parquet(f"{out}/marts/{n}")) for n in mrt.MARTS})
        audit = writers.export_all(
            spark, builds,
            lambda df, n: writers.write_jdbc(df, url, n.upper(), properties=props, num_partitions=cpus),
            parallel=4)
        failed = [r for r in audit.collect() if r["status"] != "ok"]
        if failed:
            raise RuntimeError(f"export failed: {failed}")
    timed("export", export)

    total = round(sum(q.values()), 3)
    print(json.dumps({"metric": "pipeline_seconds", "value": total, "unit": "sec",
                      "queries": q, "mart_seconds": marts, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
