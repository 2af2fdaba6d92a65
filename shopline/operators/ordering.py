"""Order statistics that stay distributed at any size.

``row_number().over(Window.orderBy(...))`` moves every row to one task.  The
operators here use a range partitioning instead, so each task sorts only its
slice, and a table of per-partition counts (one row per partition: a proven,
small broadcast) turns local positions into global ones.  The range-partitioned
rows are written once (lineage cut): range bounds come from sampling, so a
second evaluation could choose other bounds than the first.

* :func:`global_position` — exact 0-based position of every row in a total order.
  Both positions and medians start jobs when they are called.
* :func:`exact_medians`  — exact medians of columns (mean of the two middle
  values), by brackets from a sketch that exact counts check: no table of all
  values is shuffled or stored.
* :func:`most_frequent`  — mode with ties to the smallest value, as a two-level
  aggregate (no per-group value→count map held by one task).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopline.session import cut_lineage

# Distinct values of a median's bracket that are counted one by one, and the accuracy of its sketches.
BRACKET = 1_000_000
ACCURACY = 10_000

_LOCAL_BITS = 33  # monotonically_increasing_id: partition id << 33 | record number


def _by_range(df: DataFrame, partitions: int | None, *order) -> DataFrame:
    """Range-partition ``df``: into ``partitions`` if given, else as many as
    AQE makes of the shuffle (it merges small neighbouring ranges, and merged
    partitions stay contiguous ranges in order)."""
    if partitions:
        return df.repartitionByRange(int(partitions), *order)
    return df.repartitionByRange(*order)


def global_position(df: DataFrame, order: list[Column], name: str = "position",
                    partitions: int | None = None) -> DataFrame:
    """Add ``name``: the 0-based position of each row under ``order``.

    ``order`` must be a total order (end it with a unique key) so that the
    result is deterministic.
    """
    ranged = (_by_range(df, partitions, *order).sortWithinPartitions(*order)
              .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = ranged.withColumns({
        "_pid": F.shiftright(F.col("_mid"), _LOCAL_BITS),
        "_local": F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)),
    })
    # Written once: the range bounds come from sampling, and a second
    # evaluation (Spark does not reuse this exchange across the two branches
    # below) could draw other bounds.  Both branches read these stored ids.
    ranged = cut_lineage(ranged)
    # One row per partition: the rows before it.  Bounded by the partition count.
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
               .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
               .select("_pid", "_offset"))
    return (ranged.join(F.broadcast(offsets), "_pid")
            .withColumn(name, F.col("_offset") + F.col("_local"))
            .drop("_mid", "_pid", "_local", "_offset"))


@dataclass
class _Search:
    """A column's middle ranks, and the closed bracket of values that holds them."""

    column: str
    numbers: int                 # values that are not NaN
    ranks: tuple[int, int]       # of the two middle values, from 0; NaN ranks last
    low: float
    high: float
    below: int = 0               # values below ``low``
    tight: bool = False

    def has(self, v: Column) -> Column:
        return (v >= F.lit(self.low)) & (v <= F.lit(self.high)) & ~F.isnan(v)


def _number(column: str) -> Column:
    return F.col(f"`{column}`").cast("double")


def _sketched(df: DataFrame, searches: list[_Search], within: dict[str, int], accuracy: int) -> None:
    """Narrow each bracket to where a sketch says that the ranks lie, in one aggregate."""
    aggs = []
    for i, s in enumerate(searches):
        size, slack = within[s.column], 2.0 / accuracy
        at = [max(0.0, (s.ranks[0] - s.below) / size - slack), min(1.0, (s.ranks[1] - s.below + 1) / size + slack)]
        aggs.append(F.percentile_approx(F.when(s.has(_number(s.column)), _number(s.column)), at, accuracy).alias(f"q{i}"))
    row = df.agg(*aggs).first()
    for i, s in enumerate(searches):
        low, high = row[f"q{i}"]
        # A bracket that no longer shrinks is of few distinct values, or as small as a sketch can tell.
        s.tight = (low, high) == (s.low, s.high)
        s.low, s.high = low, high


def _counted(df: DataFrame, searches: list[_Search], bracket: int) -> dict[str, int]:
    """Check each bracket by exact counts; the values within those that must be narrowed further."""
    aggs = []
    for i, s in enumerate(searches):
        v = _number(s.column)
        aggs += [F.count_if(v < F.lit(s.low)).alias(f"b{i}"), F.count_if(s.has(v)).alias(f"w{i}"),
                 F.approx_count_distinct(F.when(s.has(v), v)).alias(f"d{i}")]
    row, wide = df.agg(*aggs).first(), {}
    for i, s in enumerate(searches):
        below, within, distinct = row[f"b{i}"], row[f"w{i}"], row[f"d{i}"]
        if s.ranks[0] < below:                       # the sketch was off: the middle lies lower
            s.low, s.high, s.below, wide[s.column] = float("-inf"), s.low, 0, below + within
        elif s.ranks[1] >= below + within:           # or higher
            s.low, s.high, s.below, wide[s.column] = s.high, float("inf"), below, s.numbers - below
        else:
            s.below = below
            if distinct > bracket and not s.tight:
                wide[s.column] = within
    return wide


def _median_values(df: DataFrame, columns: list[str], bracket: int, accuracy: int) -> dict[str, float | None]:
    row = df.agg(*[a for i, c in enumerate(columns) for a in (
        F.count(_number(c)).alias(f"n{i}"), F.count_if(F.isnan(_number(c))).alias(f"x{i}"))]).first()
    out: dict[str, float | None] = dict.fromkeys(columns)
    searches = []
    for i, c in enumerate(columns):
        n, numbers = row[f"n{i}"], row[f"n{i}"] - row[f"x{i}"]
        if n and n // 2 >= numbers:
            out[c] = float("nan")
        elif n:
            searches.append(_Search(c, numbers, ((n - 1) // 2, n // 2), float("-inf"), float("inf")))
    wide = {s.column: s.numbers for s in searches}
    while wide:
        pending = [s for s in searches if s.column in wide]
        _sketched(df, pending, wide, accuracy)
        wide = _counted(df, pending, bracket)
    if not searches:
        return out
    # What the brackets hold, value by value: few rows, counted map-side.
    pairs = F.array(*[F.when(s.has(_number(s.column)), F.struct(F.lit(s.column).alias("column"), _number(s.column).alias("v"))) for s in searches])
    held = df.select(F.explode(F.filter(pairs, lambda p: p.isNotNull())).alias("p")).groupBy("p.column", "p.v").agg(F.count(F.lit(1)).alias("w"))
    to = F.sum("w").over(Window.partitionBy("column").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    held = held.withColumn("to", to)
    rank = lambda k: F.coalesce(*[F.when(F.col("column") == s.column, F.lit(s.ranks[k] - s.below)) for s in searches])
    covers = lambda k: (F.col("to") - F.col("w") <= rank(k)) & (rank(k) < F.col("to"))
    picks = held.groupBy("column").agg(*[F.max(F.when(covers(k), F.col("v"))).alias(f"m{k}") for k in range(2)])
    out.update({r["column"]: (r["m0"] + r["m1"]) / 2 for r in picks.collect()})
    return out


def exact_medians(df: DataFrame, columns: list[str], *, bracket: int = BRACKET, accuracy: int = ACCURACY) -> DataFrame:
    """(column, median double) of each column: null when it has no values.

    A selection by brackets, for all columns at once; nothing but aggregates is
    shuffled.  A quantile sketch gives two values with the middle between them,
    exact counts check that and say how many values lie below, and only the
    bracket is counted value by value.  A bracket of more than ``bracket`` distinct
    values is sketched again: each round keeps about 4 / ``accuracy`` of the
    values, so two or three suffice for any table.  NaN counts as larger than any
    number and both zeros as one value, as everywhere in Spark.  Starts jobs; one value a column reaches the
    driver and a few numbers a round.
    """
    found = _median_values(df, columns, bracket, accuracy) if columns else {}
    return df.sparkSession.createDataFrame(list(found.items()), "column string, median double")


def exact_median(df: DataFrame, column: str) -> DataFrame:
    """One-row DataFrame ``(median double)``: null when there are no values."""
    return exact_medians(df, [column]).select("median")


def most_frequent(df: DataFrame, column: str) -> DataFrame:
    """One-row DataFrame ``(mode)``: most frequent non-null value, ties → smallest."""
    counts = (df.where(F.col(column).isNotNull())
              .groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("n")))
    best = counts.agg(F.min(F.struct((-F.col("n")).alias("k"), F.col("v").alias("v"))).alias("m"))
    return best.select(F.col("m.v").alias("mode"))
