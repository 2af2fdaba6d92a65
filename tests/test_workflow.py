"""The batch run end to end: CSV files → clean → consolidate → marts → JDBC."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from shopline.plans import marts, workflow
from shopline.sources import csv as csvsrc
from shopline.sources import roles

SF_DIR = "/root/testdata/sf0.001"


def test_batch_run_from_csv(spark, tmp_dir):
    raw = roles.raw_inputs(spark, SF_DIR)
    paths = {}
    for name, df in raw.items():
        path = f"{tmp_dir}/csv/{name}"
        if name == "train":
            header = spark.createDataFrame([(",".join(df.columns),)], "value string")
            lines = csvsrc.render_csv_lines(df, wrap=F.col("onpromotion") % 3 == 0)
            header.unionByName(lines).coalesce(1).write.text(path)
        else:
            df.coalesce(1).write.option("header", True).csv(path)
        paths[name] = path
    tables, load_audit = csvsrc.load_all(spark, paths)
    counts = {r["table"]: r["rows"] for r in load_audit.collect()}
    assert counts == {n: df.count() for n, df in raw.items()}

    result = workflow.run(spark, tables, f"{tmp_dir}/out", period=roles.PERIOD)
    wide = spark.read.parquet(result.consolidated_path)
    assert wide.count() == raw["train"].distinct().count()
    assert set(result.mart_paths) == set(marts.MARTS)
    assert spark.read.parquet(result.mart_paths["lag_corr"]).count() == 7
    assert spark.read.json(f"{tmp_dir}/out/audit/clean").count() > 0
    assert result.rows["consolidated"] == wide.count()
    assert result.rows["sales_by_family"] == spark.read.parquet(result.mart_paths["sales_by_family"]).count()
    steps = {r["step"]: r for r in spark.read.json(f"{tmp_dir}/out/audit/steps").collect()}
    assert steps["load_train"]["rows"] == raw["train"].count()

    url = f"jdbc:derby:memory:w{uuid.uuid4().hex[:8]};create=true"
    audit = workflow.export(spark, result, url, properties={"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
    assert {r["status"] for r in audit.collect()} == {"ok"}
    assert {r["table"]: r["rows"] for r in audit.collect()} == {n: result.rows[n] for n in ["consolidated", *result.mart_paths]}
    back = (spark.read.format("jdbc").option("url", url).option("dbtable", "SALES_BY_FAMILY")
            .option("driver", "org.apache.derby.jdbc.EmbeddedDriver").load())
    assert back.count() == spark.read.parquet(result.mart_paths["sales_by_family"]).count()
