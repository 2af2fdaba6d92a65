"""Typed CSV sources, with repair of double-encoded lines (SRC1-7).

A double-encoded line is a whole CSV record that was written again as one
quoted CSV field: ``"1,2013-01-01,1,""BREAD,X"",0.5,0"``.  Such a line parses
to exactly one field.  The repair is a column expression over the records of the
file — detect the single quoted field, strip the outer quotes, un-double the
inner ones — followed by ``from_csv`` with the typed schema in FAILFAST mode, so
the file is read in parallel splits and never rewritten.

Records are found by quote parity, so a quoted field may hold line ends and the
file is split all the same (:func:`read_records`).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopline.schemas import INPUTS, SALES
from shopline.session import cut_lineage

QUOTE = '"'
CSV_OPTIONS = {"mode": "FAILFAST", "escape": '"', "dateFormat": "yyyy-MM-dd"}


def _inner(line: Column) -> Column:
    return F.substring(line, F.lit(2), F.length(line) - 2)


def is_wrapped(line: Column) -> Column:
    """True for a line that is exactly one quoted CSV field: within the outer quotes all others are doubled."""
    outer = F.startswith(line, F.lit(QUOTE)) & F.endswith(line, F.lit(QUOTE)) & (F.length(line) >= 2)
    return outer & ~F.contains(F.replace(_inner(line), F.lit(QUOTE * 2), F.lit("")), F.lit(QUOTE))


def unwrap(line: Column) -> Column:
    """Inner text of a one-field line: outer quotes off, ``""`` → ``"``."""
    return F.replace(_inner(line), F.lit(QUOTE * 2), F.lit(QUOTE))


def read_records(spark: SparkSession, path: str, *, header: str | None = None) -> DataFrame:
    """The CSV records of a file or folder as text (``value``), whatever line ends stand within quotes.

    The text is read in splits.  A line with an odd number of quotes opens or closes
    a quoted field; their parity per split, summed over the splits of a file
    before it, tells whether a split begins within a field.  Where a field runs
    over a line end, the scan joins the lines of a record as it reads them, and
    only the pieces of records that go over the border of a split are
    shuffled; every other line is a record as it stands.  A file that ends within quotes ends its last record there.
    ``header``: this text is dropped where it is a file's first line.  A
    carriage return at the end of a record is no part of it.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    lines = lines.withColumn("odd", quotes % 2)
    # One row a split.
    splits = lines.groupBy("file", "start").agg(F.sum("odd").alias("odds"), F.min("at").alias("first"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("inside", F.coalesce(F.sum("odds").over(before), F.lit(0)) % 2)
    splits = cut_lineage(splits.withColumn("mixed", (F.col("odds") > 0) | (F.col("inside") > 0)))
    marks = splits.where("mixed" if header is None else "mixed OR start = 0").select("file", "start", "first", "inside", "mixed")
    n_splits, n_mixed = splits.agg(F.count(F.lit(1)), F.count_if("mixed")).first()
    # Sent to every task, one row a split: a join that shuffles would lose the order of the lines.
    lines = lines.join(F.broadcast(marks), ["file", "start"], "left")
    if header is not None:
        at_top = (F.col("start") == 0) & (F.col("at") == F.col("first"))
        lines = lines.where(~(F.coalesce(at_top, F.lit(False)) & _without_cr(F.col("value")).eqNullSafe(F.lit(header))))
    mixed = F.coalesce(F.col("mixed"), F.lit(False))
    plain = lines.where(~mixed).select("value")
    if n_mixed:
        cut = lines.where(mixed).select("first", "inside", "odd", "value")
        # At most two pieces a split, its first lines and its last record, are shuffled.
        pieces = _joined_lines(cut, whole=False).join(F.broadcast(splits.select("first", "file", "start")), "first")
        upto = Window.partitionBy("file").orderBy("start", "tail").rowsBetween(Window.unboundedPreceding, 0)
        pieces = pieces.withColumn("of", F.sum(F.col("tail").cast("long")).over(upto))
        joined = pieces.groupBy("file", "of").agg(F.sort_array(F.collect_list(F.struct("start", "tail", "value"))).alias("lines"))
        records = _joined_lines(cut, whole=True).select("value").unionByName(joined.select(F.concat_ws("\n", F.col("lines.value")).alias("value")))
        plain = records if n_mixed == n_splits else plain.unionByName(records)
    return plain.select(_without_cr(F.col("value")).alias("value"))


def _joined_lines(lines: DataFrame, *, whole: bool) -> DataFrame:
    """(first, tail, value) from the lines (first, inside, odd, value) of the splits named ``first``, in order.

    ``whole``: the records that end in the split where they begin; else the pieces
    of all others, which are the lines of a split before its first record and its
    last record, if that goes on (``tail``).  Lines are joined within the scan, a
    batch at a time, so nothing is shuffled.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    schema = pa.schema([("first", pa.int64()), ("tail", pa.bool_()), ("value", pa.large_binary())])

    def rows(split: int, tail: bool, values: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(values), split, np.int64)), pa.array(np.full(len(values), tail)), values], schema=schema)

    def one(split: int, tail: bool, parts: list[bytes]) -> pa.RecordBatch:
        return rows(split, tail, pa.array([b"\n".join(parts)], pa.large_binary()))

    def run(batches):
        # The split, the parity of its quotes, and its last lines: of a record that began in it, or of none.
        now, odd, held, begun = None, 0, [], False
        for batch in batches:
            splits = batch.column(0).to_numpy(zero_copy_only=False)
            borders = [0, *(np.flatnonzero(splits[1:] != splits[:-1]) + 1).tolist(), len(splits)]
            for lo, hi in zip(borders, borders[1:], strict=False):
                if lo == hi:
                    continue
                part = batch.slice(lo, hi - lo)
                if splits[lo] != now:
                    if held and whole == (begun and not odd):
                        yield one(now, begun, held)
                    now, odd, held, begun = int(splits[lo]), part.column(1)[0].as_py(), [], False
                quotes = np.concatenate([[odd], part.column(2).to_numpy(zero_copy_only=False)]).cumsum()
                odd = int(quotes[-1] % 2)
                # A line that doesn't begin within quotes begins a record.
                starts = np.flatnonzero(quotes[:-1] % 2 == 0)
                values = part.column(3).cast(pa.large_binary())
                if not len(starts):
                    held += values.to_pylist()
                    continue
                held += values.slice(0, int(starts[0])).to_pylist()
                if held and whole == begun:
                    yield one(now, False, held)
                if whole and len(starts) > 1:
                    inner = pa.LargeListArray.from_arrays(pa.array(starts, pa.int64()), values)
                    yield rows(now, False, pc.binary_join(inner, pa.scalar(b"\n", pa.large_binary())))
                held, begun = values.slice(int(starts[-1])).to_pylist(), True
        if held and whole == (begun and not odd):
            yield one(now, begun, held)

    made = lines.select("first", F.col("inside").cast("int"), F.col("odd").cast("int"), F.col("value").cast("binary"))
    return made.mapInArrow(run, "first long, tail boolean, value binary").withColumn("value", F.col("value").cast("string"))


def _without_cr(value: Column) -> Column:
    return F.when(F.endswith(value, F.lit("\r")), F.substring(value, F.lit(1), F.length(value) - 1)).otherwise(value)


def parse_csv_lines(lines: DataFrame, schema: T.StructType, *, header: bool = True,
                    column: str = "value", keep_flag: bool = False) -> DataFrame:
    """Typed rows from a DataFrame of CSV records as text; wrapped ones repaired.

    ``header``: records that equal the header's text are dropped (a reader of
    files drops it by its place instead).
    With ``keep_flag`` the boolean column ``repaired`` tells which rows were
    double-encoded (``sum`` of it is the repair count).
    """
    line = F.col(column)
    if header:
        lines = lines.where(line != F.lit(",".join(schema.fieldNames())))
    wrapped = is_wrapped(line)
    text = F.when(wrapped, unwrap(line)).otherwise(line)
    parsed = lines.select(F.from_csv(text, schema.simpleString(), CSV_OPTIONS).alias("_r"),
                          wrapped.alias("repaired"))
    cols = [F.col(f"_r.`{f.name}`").alias(f.name) for f in schema.fields]
    return parsed.select(*cols, *(["repaired"] if keep_flag else []))


def read_sales_csv(spark: SparkSession, path: str, schema: T.StructType = SALES,
                   keep_flag: bool = False) -> DataFrame:
    """The sales file: records → repair → typed rows (SRC1 + SRC6).  Starts a job
    that counts the quotes of each split."""
    try:
        records = read_records(spark, path, header=",".join(schema.fieldNames()))
    except AnalysisException as e:
        raise FileNotFoundError(f"cannot load table 'train' from {path}: {e}") from e
    return parse_csv_lines(records, schema, header=False, keep_flag=keep_flag)


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType, name: str) -> DataFrame:
    """A header CSV with an explicit schema (SRC2-5).  A header with other names or
    another order fails the job, and so does a malformed row."""
    try:
        return (spark.read.schema(schema).option("header", True).option("enforceSchema", False)
                .options(**CSV_OPTIONS).csv(path))
    except AnalysisException as e:
        raise FileNotFoundError(f"cannot load table {name!r} from {path}: {e}") from e


def load_all(spark: SparkSession, paths: dict[str, str]) -> tuple[dict[str, DataFrame], DataFrame]:
    """Load the five tables in order, with their audit (SRC7, PRF1).

    A missing file raises at once naming the table.  The audit (table, rows,
    columns, nulls, repaired) is lazy; computing it parses every column of every
    row, so a malformed row or header fails there at the latest.
    """
    flagged: dict[str, DataFrame] = {}
    for name, schema in INPUTS.items():
        if name == "train":
            flagged[name] = read_sales_csv(spark, paths[name], schema, keep_flag=True)
        else:
            flagged[name] = read_csv_table(spark, paths[name], schema, name)
    return {n: df.drop("repaired") for n, df in flagged.items()}, load_audit(flagged)


def load_audit(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows, columns, nulls, repaired) in one pass over all columns; a
    boolean column ``repaired`` is the repair flag, not data."""
    parts = []
    for name, df in tables.items():
        data = [c for c in df.columns if c != "repaired"]
        nulls = sum((F.coalesce(F.sum(F.col(f"`{c}`").isNull().cast("bigint")), F.lit(0)) for c in data), F.lit(0))
        fixed = F.coalesce(F.sum(F.col("repaired").cast("bigint")), F.lit(0)) if "repaired" in df.columns else F.lit(0)
        parts.append(df.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows"), F.lit(len(data)).alias("columns"),
                            nulls.cast("bigint").alias("nulls"), fixed.cast("bigint").alias("repaired")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _field_text(c: Column, dtype: T.DataType) -> Column:
    text = c.cast("string")
    if isinstance(dtype, T.StringType):
        needs = text.rlike('[",\r\n]')
        quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.when(needs, quoted).otherwise(text)
    return text


def render_csv_lines(df: DataFrame, wrap: Column | None = None) -> DataFrame:
    """CSV text lines (``value``) of the rows of ``df``; null → empty field.

    ``wrap``: rows for which it is true are written double-encoded, i.e. the
    whole line once more as one quoted field.
    """
    fields = [F.coalesce(_field_text(F.col(f"`{f.name}`"), f.dataType), F.lit(""))
              for f in df.schema.fields]
    line = F.concat_ws(",", *fields)
    if wrap is not None:
        line = F.when(wrap, F.concat(F.lit('"'), F.replace(line, F.lit('"'), F.lit('""')), F.lit('"'))
                      ).otherwise(line)
    return df.select(line.alias("value"))
