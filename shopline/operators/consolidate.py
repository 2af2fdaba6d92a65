"""One wide table: sales ⟕ stores ⟕ transactions ⟕ prices ⟕ holidays.

Plan at scale: every dimension whose size is proven small is broadcast, so the
fact table is read once and not shuffled by those joins; a dimension that is
too big to broadcast (e.g. store-day transactions of a very large chain) is a
sort-merge join, where AQE splits skewed (hot store-day) partitions of the fact
side; that join comes first, so that only the columns of the sales rows are
shuffled and the broadcast dimensions are added behind it.  The holiday calendar is collapsed to one row per date by one hash
aggregate (partial aggregation map-side, so a date with a huge number of rows
is combined before the shuffle), which keeps the left joins from fanning out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopline.functions.sizing import bounded_broadcast
from shopline.schemas import CONSOLIDATED_COLUMNS, HOLIDAY_COLUMNS, NATIONAL_FLAG

# The preferred holiday type, and the order of locales used to
# break ties between several rows of that type on one date.
PREFERRED_TYPE = "Holiday"
NATIONAL_LOCALE = "National"
LOCALE_ORDER = ("National", "Regional", "Local")


def holidays_per_date(holidays: DataFrame) -> DataFrame:
    """One representative row per date plus the national-holiday flag (CON1-3).

    Representative: rows of the preferred type first, then locale
    (National, Regional, Local, other), locale name, description, transferred.
    Flag: some row of the date is National and not transferred, whatever its type.
    """
    locale_rank = F.lit(len(LOCALE_ORDER) + 1)
    for i, name in reversed(list(enumerate(LOCALE_ORDER, start=1))):
        locale_rank = F.when(F.col("locale") == name, i).otherwise(locale_rank)
    ordering = F.struct(
        (F.col("type") != F.lit(PREFERRED_TYPE)).alias("_not_preferred"),
        locale_rank.alias("_locale_rank"),
        F.col("locale_name").alias("_n"), F.col("description").alias("_d"),
        F.col("transferred").alias("_t"), F.col("type").alias("_y"),
        F.col("locale").alias("_l"),
    )
    national = (F.col("locale") == NATIONAL_LOCALE) & (F.col("transferred") == F.lit(False))
    per_date = holidays.groupBy("date").agg(
        F.min(ordering).alias("_rep"),
        F.coalesce(F.bool_or(national), F.lit(False)).alias(NATIONAL_FLAG),
    )
    return per_date.select(
        "date",
        F.col("_rep._y").alias(HOLIDAY_COLUMNS["type"]),
        F.col("_rep._l").alias(HOLIDAY_COLUMNS["locale"]),
        F.col("_rep._n").alias(HOLIDAY_COLUMNS["locale_name"]),
        F.col("_rep._d").alias(HOLIDAY_COLUMNS["description"]),
        F.col("_rep._t").alias(HOLIDAY_COLUMNS["transferred"]),
        NATIONAL_FLAG,
    )


def consolidate(tables: dict[str, DataFrame],
                sizes: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    """Four left joins onto the sales rows; row count is preserved (CON4-7).

    Dimensions must be unique on their join keys (see :func:`key_violations`);
    the holiday calendar is made so here.  ``sizes``: measured ``(rows,
    bytes)`` of the cleaned tables (observed by the clean step); a dimension
    measured small is broadcast (the per-date holiday table is no larger than
    the holiday rows it comes from), for all others Spark chooses the join.
    """
    sizes = sizes or {}
    sales = tables["train"]
    names = ["stores", "oil", "holidays", "transactions"]
    dims = [tables["stores"],
            tables["oil"].select("date", "dcoilwtico"),
            holidays_per_date(tables["holidays"]),
            tables["transactions"].select("store_nbr", "date", "transactions")]
    stores, prices, per_date, trans = (bounded_broadcast(d, sizes.get(n)) for d, n in zip(dims, names))
    out = (sales
           .join(trans, ["store_nbr", "date"], "left")
           .join(stores, "store_nbr", "left")
           .join(prices, "date", "left")
           .join(per_date, "date", "left")
           .fillna(False, [NATIONAL_FLAG]))
    return out.select(*CONSOLIDATED_COLUMNS)


def key_violations(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """Keys that occur more than once in a dimension (CON8): (table, key, n)."""
    key_text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
            .select(F.lit(table).alias("table"), key_text.alias("key"), "n"))


def fanout_audit(tables: dict[str, DataFrame], consolidated: DataFrame) -> DataFrame:
    """One row: base rows, consolidated rows, rows added by joins, columns (CON8)."""
    base = tables["train"].agg(F.count(F.lit(1)).alias("base_rows"))
    wide = consolidated.agg(F.count(F.lit(1)).alias("consolidated_rows"))
    out = base.withColumn("consolidated_rows", wide.scalar())
    return out.select(
        "base_rows", "consolidated_rows",
        (F.col("consolidated_rows") - F.col("base_rows")).alias("rows_added_by_joins"),
        F.lit(len(consolidated.columns)).alias("columns"))
