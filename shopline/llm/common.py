"""Helpers shared by the operators of this package."""

from __future__ import annotations

import atexit
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopline.session import cut_lineage, drop_stored

#: ASCII blanks: words are maximal runs of other characters.
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

stored = cut_lineage
drop = drop_stored


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def residue(doc_id: Column, m: int) -> Column:
    """crc32 of the id's decimal text, modulo ``m`` (null for a null id)."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(m))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def word_array(text: Column) -> Column:
    """Words of ``text`` in order; an empty array for null or blank text."""
    spaced = F.trim(F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     "))
    return F.filter(F.split(spaced, " +"), lambda w: w != "")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this library, so that their Python finds it whatever
    the folder or path that the driver was started with."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import shopline

    root = Path(shopline.__file__).resolve().parent
    # The driver serves the file for as long as it lives.
    folder = tempfile.TemporaryDirectory(prefix="shopline-library-")
    atexit.register(folder.cleanup)
    archive = Path(folder.name, "shopline_library.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, Path(root.name, f.relative_to(root)))
    sc.addPyFile(str(archive))
    _SHIPPED.add(sc.applicationId)


def by_stream(df: DataFrame, columns: list[Column], schema: str,
              make: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]]) -> DataFrame:
    """Run a generator over each task's Arrow batches of ``columns``.

    The generator gets the batches in bounded slices and yields dicts of
    column values (lists or Arrow arrays) named as in ``schema``.  Text columns
    are best cast to binary, so that bytes that are not UTF-8 arrive as they are.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ship_package(df.sparkSession)
    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for made in make(part for batch in batches for part in _cut(batch)):
            yield pa.RecordBatch.from_arrays(
                [a.cast(f.type) if isinstance(a := made[f.name], pa.Array) else pa.array(a, type=f.type) for f in out], schema=out)

    return df.select(*columns).mapInArrow(run, schema)


def by_batch(df: DataFrame, columns: list[Column], schema: str,
             make: Callable[[], Callable[[pa.RecordBatch], dict]]) -> DataFrame:
    """As :func:`by_stream`, for a function of one batch that ``make`` sets up in each task."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        step = make()
        return map(step, batches)

    return by_stream(df, columns, schema, stream)


#: Work units of a batch function: about so many bytes of input at a time.
BATCH_BYTES = 8 << 20


def _cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about BATCH_BYTES, so that a batch of long texts
    doesn't have all its Python objects alive at once."""
    n = batch.num_rows
    step = max(1, min(n, int(n * BATCH_BYTES / max(1, batch.nbytes))))
    for i in range(0, n, step):
        yield batch.slice(i, step)


def decoded(values: pa.Array) -> list[str]:
    """Binary column to texts: null is empty, bad bytes become U+FFFD."""
    return [b.decode("utf-8", "replace") if b else "" for b in values.to_pylist()]


