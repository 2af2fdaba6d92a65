"""Typed schemas of the five inputs and of the consolidated table.

Every reader uses these explicitly (no schema inference), so a malformed value
fails the job under ``mode=FAILFAST`` instead of silently becoming a string.
"""

from __future__ import annotations

from pyspark.sql import types as T

SALES = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("date", T.DateType()),
    T.StructField("store_nbr", T.LongType()),
    T.StructField("family", T.StringType()),
    T.StructField("sales", T.DoubleType()),
    T.StructField("onpromotion", T.LongType()),
])

STORES = T.StructType([
    T.StructField("store_nbr", T.LongType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("cluster", T.LongType()),
])

TRANSACTIONS = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("store_nbr", T.LongType()),
    T.StructField("transactions", T.LongType()),
])

PRICES = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("dcoilwtico", T.DoubleType()),
])

HOLIDAYS = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("type", T.StringType()),
    T.StructField("locale", T.StringType()),
    T.StructField("locale_name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("transferred", T.BooleanType()),
])

# Table name -> schema, in the load order of the batch run.
INPUTS: dict[str, T.StructType] = {
    "train": SALES,
    "stores": STORES,
    "transactions": TRANSACTIONS,
    "oil": PRICES,
    "holidays": HOLIDAYS,
}

# Names of the per-date holiday columns added by the consolidation.
HOLIDAY_COLUMNS = {
    "type": "holiday_type",
    "locale": "holiday_locale",
    "locale_name": "holiday_locale_name",
    "description": "holiday_description",
    "transferred": "holiday_transferred",
}
NATIONAL_FLAG = "is_national_holiday"

CONSOLIDATED_COLUMNS = (
    [f.name for f in SALES.fields]
    + ["city", "state", "type", "cluster", "transactions", "dcoilwtico"]
    + list(HOLIDAY_COLUMNS.values()) + [NATIONAL_FLAG]
)
