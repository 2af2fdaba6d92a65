"""Calendar keys."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def year_month(c: str | Column) -> Column:
    """``YYYY-MM`` text of a date (sorts chronologically)."""
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM")


def in_period(c: str | Column, start: str | dt.date, end: str | dt.date) -> Column:
    """Closed date range ``start <= c <= end`` (pushed down to Parquet)."""
    col = F.col(c) if isinstance(c, str) else c
    return col.between(F.lit(start).cast("date"), F.lit(end).cast("date"))
