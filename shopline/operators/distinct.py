"""Distinct rows by fingerprint: whole rows are shuffled only where they may repeat (CLN1, PRF3).

1. A 64-bit fingerprint of every row goes through one aggregate; fingerprints
   seen twice or more are kept.
2. They become a bitmap of at most ``MOST_BITS``, which the scan looks into.
3. Rows that it doesn't mark are unique and pass as they are; marked rows are
   compared as a whole by a hash aggregate.

A mark is only a reason to compare: equal fingerprints of different rows, and
bits that several fingerprints share, cost a shuffled row and change nothing.
With more repeated fingerprints than the bitmap has room for, most rows are
marked and the cost is that of the plain aggregate.  The table is read three
times, so this pays for wide rows with few repeats; it must give the same rows
each time (a stored table or files).  Both calls start jobs.

Edge cases: nulls are equal to each other, as are NaN and the two zeros; an
empty table gives an empty result; a column of a type whose hash could tell equal values apart (nested
types, text with a collation) sends the table to the plain aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopline.session import cut_lineage

#: Bits for each repeated fingerprint, and the bounds of the bitmap (16 MB at most).
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 27
#: Types whose equal values have equal hashes.
HASHED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType,
          T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)


def has_fingerprint(df: DataFrame) -> bool:
    """Whether equal rows of ``df`` always have equal fingerprints."""
    types = [f.dataType for f in df.schema.fields]
    return bool(types) and all(isinstance(t, HASHED) or t == T.StringType() for t in types)


def fingerprint(df: DataFrame) -> Column:
    """64-bit hash of a row: its values, and which of them are null."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    return F.xxhash64(*cols, *[c.isNull() for c in cols])


def repeated_fingerprints(df: DataFrame) -> DataFrame:
    """(f): fingerprints of two rows or more.  Copies are combined before the
    shuffle, and no value of a row takes part in it."""
    return (df.select(fingerprint(df).alias("f")).groupBy("f")
            .agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("f"))


def _mark(df: DataFrame, again: DataFrame, size: int) -> Column:
    """A test that is true for every row whose fingerprint is in ``again``, and for few others."""
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_EACH * size).bit_length()))
    place = F.col("f").bitwiseAND(F.lit(bits - 1))
    words = (again.groupBy(F.shiftright(place, 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(f & 63 as int))")).alias("bits")))
    # bits / 64 rows, whatever the number of fingerprints.
    every = df.sparkSession.range(bits // 64).withColumnRenamed("id", "word").join(words, "word", "left")
    cells = F.sort_array(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0)).alias("bits"))))
    bitmap = every.agg(F.transform(cells, lambda x: x["bits"]).alias("a")).scalar()
    f = fingerprint(df)
    word = F.get(bitmap, F.shiftright(f.bitwiseAND(F.lit(bits - 1)), 6).cast("int"))
    return F.getbit(word, f.bitwiseAND(F.lit(63)).cast("int")) == 1


def split_by_repeats(df: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Rows that are certainly unique, and those that may repeat (None: no row does)."""
    if not has_fingerprint(df):
        return df.limit(0), df
    again = cut_lineage(repeated_fingerprints(df))
    size = again.count()
    if not size:
        return df, None
    mark = _mark(df, again, size)
    return df.filter(~mark), df.filter(mark)


def distinct_rows(df: DataFrame) -> DataFrame:
    """The distinct rows of ``df`` (CLN1)."""
    single, several = split_by_repeats(df)
    return single if several is None else single.union(several.dropDuplicates())


def duplicate_rows(df: DataFrame) -> DataFrame:
    """(rows, duplicate_rows): rows of ``df``, and how many a distinct would drop (PRF3)."""
    _, several = split_by_repeats(df)
    total = df.agg(F.count(F.lit(1)).alias("rows"))
    if several is None:
        return total.withColumn("duplicate_rows", F.lit(0).cast("bigint"))
    copies = several.groupBy(*[F.col(f"`{c}`") for c in several.columns]).agg(F.count(F.lit(1)).alias("__copies"))
    dropped = copies.agg(F.coalesce(F.sum(F.col("__copies") - 1), F.lit(0)).alias("n"))
    return total.withColumn("duplicate_rows", dropped.scalar())
