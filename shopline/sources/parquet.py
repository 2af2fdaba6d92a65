"""Parquet source for the written marts (SRC8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_marts(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    """``{name: DataFrame}`` for each mart written under ``folder/name``."""
    return {n: spark.read.parquet(f"{folder}/{n}") for n in names}
