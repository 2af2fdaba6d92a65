"""The five retail inputs, derived from the synthetic star-schema tables.

The test data is TPC-H shaped; this module maps it onto the retail roles so
that every query reads the given tables and its work grows with them.  Two
roles have gaps by their shape, as the real feeds have: no transactions on
Sundays, no prices on weekends; those days are the unmatched rows of the joins.

============  ==============================================================
sales         lineitem ⋈ part: ship date, supplier = store, brand = family,
              extended price = sales, discount in % = items on promotion
stores        supplier ⋈ nation ⋈ region: nation = city, region = state
transactions  distinct orders per supplier and ship day, Sundays absent
prices        mean order total per order date, weekdays only, blank on the
              1st, 2nd and 16th of each month (interior and edge gaps)
holidays      all orders: many rows per date, every type and locale, both
              ``transferred`` values
============  ==============================================================
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Fixed values of the role mapping.
STORE_TYPES = "ABCDE"          # store type letter = STORE_TYPES[suppkey % 5]
CLUSTERS = 17                  # cluster = suppkey % 17 + 1
PRICE_GAP_DAYS = (1, 2, 16)    # day-of-month with a blank price
# Analysis period of the lag / city correlations on this data.
PERIOD = ("1998-01-01", "1999-12-31")


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        "l_extendedprice", "l_discount", "l_shipdate")
    part = _read(spark, sf_dir, "part").select("p_partkey", "p_brand")
    joined = li.join(part, li.l_partkey == part.p_partkey, "left")
    return joined.select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).cast("bigint").alias("id"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_suppkey").cast("bigint").alias("store_nbr"),
        F.col("p_brand").alias("family"),
        F.col("l_extendedprice").cast("double").alias("sales"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("onpromotion"),
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = _read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey, "left")
    joined = sup.join(geo, sup.s_nationkey == geo.n_nationkey, "left")
    letter = F.substring(F.lit(STORE_TYPES), (F.col("s_suppkey") % len(STORE_TYPES) + 1).cast("int"), 1)
    return joined.select(
        F.col("s_suppkey").cast("bigint").alias("store_nbr"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        letter.alias("type"),
        (F.col("s_suppkey") % CLUSTERS + 1).cast("bigint").alias("cluster"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_orderkey", F.col("l_shipdate").cast("date").alias("date"))
    # Distinct (supplier, day, order) first: a plain two-level hash aggregate
    # with map-side combine, no per-group distinct sets.
    per_order = li.where(F.dayofweek("date") != 1).distinct()
    return (per_order.groupBy("date", F.col("l_suppkey").cast("bigint").alias("store_nbr"))
            .agg(F.count(F.lit(1)).alias("transactions")))


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("date"), "o_totalprice")
    # Mean order total in whole cents, rounded half up with integer arithmetic
    # (exact, so every engine gets the same price).
    daily = (o.where(~F.dayofweek("date").isin(1, 7))
             .groupBy("date")
             .agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("_c"),
                  F.count("o_totalprice").alias("_n"))
             .select("date", (F.expr("(2 * _c + _n) div (2 * _n)") / 100.0).alias("price")))
    gap = F.dayofmonth("date").isin(*PRICE_GAP_DAYS)
    return daily.select("date", F.when(~gap, F.col("price")).alias("dcoilwtico"))


def _holiday_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    kind = (F.when(F.col("o_orderstatus") == "F", "Holiday")
            .when(F.col("o_orderstatus") == "O", "Event")
            .when(F.col("o_custkey") % 2 == 0, "Transfer")
            .otherwise("Work Day"))
    locale = (F.when(F.col("o_custkey") % 3 == 0, "National")
              .when(F.col("o_custkey") % 3 == 1, "Regional")
              .otherwise("Local"))
    locale_name = (F.when(locale == "National", F.lit("Country"))
                   .when(locale == "Regional", F.concat(F.lit("Region "), (F.col("o_custkey") % 5).cast("string")))
                   .otherwise(F.concat(F.lit("City "), (F.col("o_custkey") % 25).cast("string"))))
    return o.select(
        F.col("o_orderdate").cast("date").alias("date"),
        kind.alias("type"),
        locale.alias("locale"),
        locale_name.alias("locale_name"),
        F.concat(kind, F.lit(" "), F.col("o_orderkey").cast("string")).alias("description"),
        (F.col("o_orderkey") % 4 == 0).alias("transferred"),
        "o_totalprice",
    )


def holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _holiday_rows(spark, sf_dir).drop("o_totalprice")


def inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All five inputs, keyed like the batch run's load step."""
    return {
        "train": sales(spark, sf_dir),
        "stores": stores(spark, sf_dir),
        "transactions": transactions(spark, sf_dir),
        "oil": prices(spark, sf_dir),
        "holidays": holidays(spark, sf_dir),
    }


# ---------------------------------------------------------------- dirty inputs
# Raw feeds with the defects the cleaning step repairs, derived by rule from the
# same tables: returned-and-finished lines are booked twice, untaxed lines lost
# their amount, 50-unit lines their promotion count, 10 %-discount lines their
# family; cheap orders lost the transfer flag, expensive local ones the
# locale name.

def dirty_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    part = _read(spark, sf_dir, "part").select("p_partkey", "p_brand")
    rows = li.join(part, li.l_partkey == part.p_partkey, "left").select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).cast("bigint").alias("id"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_suppkey").cast("bigint").alias("store_nbr"),
        F.when(F.col("l_discount") != 0.1, F.col("p_brand")).alias("family"),
        F.when(F.col("l_tax") != 0.0, F.col("l_extendedprice")).cast("double").alias("sales"),
        F.when(F.col("l_quantity") != 50.0, F.round(F.col("l_discount") * 100))
         .cast("bigint").alias("onpromotion"),
        ((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")).alias("_twice"),
    )
    # Both copies come from one scan and one join.
    copies = F.when(F.col("_twice"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("_copy", F.explode(copies)).drop("_twice", "_copy")


def dirty_holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = _holiday_rows(spark, sf_dir)
    return h.select(
        "date", "type", "locale",
        F.when(~((F.col("locale") == "Local") & (F.col("o_totalprice") > 400000)),
               F.col("locale_name")).alias("locale_name"),
        "description",
        F.when(F.col("o_totalprice") >= 20000, F.col("transferred")).alias("transferred"),
    )


def raw_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five inputs as the cleaning step receives them (with defects)."""
    tables = inputs(spark, sf_dir)
    tables["train"] = dirty_sales(spark, sf_dir)
    tables["holidays"] = dirty_holidays(spark, sf_dir)
    return tables
