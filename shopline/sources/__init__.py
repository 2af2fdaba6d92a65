"""Readers: typed CSV with double-encoding repair, Parquet, role tables."""

from shopline.sources.csv import (
    load_all, parse_csv_lines, read_csv_table, read_sales_csv, render_csv_lines,
)
from shopline.sources.parquet import read_marts

__all__ = [
    "load_all", "parse_csv_lines", "read_csv_table", "read_sales_csv",
    "render_csv_lines", "read_marts",
]
