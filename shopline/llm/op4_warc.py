"""WARC archives as a chunked record table.

Writing: each payload becomes one WARC record, or a segmented one (WARC 1.0
segmentation: the first record and its continuations) where it is longer than
``chunk_bytes``.  A row of the written frame is one whole segment, so Spark's
own text writer and its commit protocol make the archives, in any file system
that Spark reaches; a lost task's files are written anew by its next attempt.

Reading: gzip files are read front to back in one task each, as lines.  The
parser keeps one segment and the running SHA-256 of the open record, so the
memory needed is that of a chunk however long the record is.  Every chunk is a
row of (record_id, chunk_no) with the bytes and the digest up to its end.

Payloads that are equal are written once: the record with the smallest id is
the response, the others are revisits that refer to it.

Edge cases: a null payload is an empty one; rows with equal id and payload are
all responses; a null id counts as larger than any other (alone, it is a
response) and reads back as null; line ends in URLs are percent-encoded; an
empty table writes an archive without records; other columns are not written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopline.llm.common import by_stream, stored, table
from shopline.session import write_scratch

CRLF = "\r\n"
VERSION = "WARC/1.0"
PREFIX, NO_ID = "urn:page:", "urn:page-without-id"

CHUNK_SCHEMA = ("record_id string, record_type string, refers_to string, target_uri string, declared_digest string, "
                "chunk_no long, is_last boolean, bytes_so_far long, digest_so_far string")


def with_revisits(df: DataFrame, record_id: str, payload: str, min_bytes: int = 100) -> DataFrame:
    """Add payload_digest, payload_bytes, record_type and refers_to.

    The smallest id of each payload is a partial aggregate over digests, so a
    payload with a third of all copies is one row a task before the shuffle;
    the join back is left to Spark's skew handling.
    """
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = df.withColumns({"payload_digest": F.sha2(body, 256), "payload_bytes": F.octet_length(body).cast("long")})
    first = (rows.filter(F.col("payload_bytes") >= min_bytes).groupBy(F.col("payload_digest").alias("__digest"))
             .agg(F.min(record_id).alias("__first"), F.count(F.lit(1)).alias("__copies")).filter("__copies > 1"))
    rows = rows.join(first, rows.payload_digest == first["__digest"], "left")
    revisit = F.col("__copies").isNotNull() & ~F.col(record_id).eqNullSafe(F.col("__first"))
    return (rows.withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
            .withColumn("refers_to", F.when(revisit, F.col("__first"))).drop("__digest", "__first", "__copies"))


def _uri(record_id: Column) -> Column:
    return F.coalesce(F.concat(F.lit(PREFIX), record_id.cast("string")), F.lit(NO_ID))


def segments(df: DataFrame, record_id: str, payload: str, uri: str, chunk_bytes: int = 1 << 20,
             date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """One row per WARC segment, as text without its last line end."""
    body = F.when(F.col("record_type") == "response", F.coalesce(F.col(payload), F.lit("")).cast("binary")).otherwise(F.lit(b""))
    parts = F.greatest(F.lit(1), F.ceil(F.octet_length("__body") / chunk_bytes))
    rows = (df.withColumn("__body", body).withColumn("__parts", parts.cast("long"))
            .withColumn("__no", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__parts")))))
    rows = rows.withColumn("__chunk", F.expr(f"substring(__body, int((__no - 1) * {chunk_bytes} + 1), {chunk_bytes})"))
    safe = F.replace(F.replace(F.coalesce(F.col(uri), F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    line = lambda name, value: F.concat(F.lit(f"{CRLF}{name}: "), value)
    none, first, last = F.lit(""), F.col("__no") == 1, F.col("__no") == F.col("__parts")
    head = F.concat(
        F.lit(VERSION),
        line("WARC-Type", F.when(first, F.col("record_type")).otherwise("continuation")),
        line("WARC-Record-ID", F.concat(F.lit("<"), _uri(F.col(record_id)), F.when(first, ">").otherwise(F.concat(F.lit("#"), F.col("__no").cast("string"), F.lit(">"))))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", safe),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        F.when(F.col("refers_to").isNotNull(), line("WARC-Refers-To", F.concat(F.lit("<"), _uri(F.col("refers_to")), F.lit(">")))).otherwise(none),
        F.when(F.col("__parts") > 1, line("WARC-Segment-Number", F.col("__no").cast("string"))).otherwise(none),
        F.when(~first, line("WARC-Segment-Origin-ID", F.concat(F.lit("<"), _uri(F.col(record_id)), F.lit(">")))).otherwise(none),
        F.when((F.col("__parts") > 1) & last, line("WARC-Segment-Total-Length", F.col("payload_bytes").cast("string"))).otherwise(none),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.octet_length("__chunk").cast("string")),
        F.lit(CRLF + CRLF))
    return rows.select(F.concat(head.cast("binary"), F.col("__chunk"), F.lit(CRLF).cast("binary")).cast("string").alias("value"))


def write_archives(df: DataFrame, path: str, record_id: str, payload: str, uri: str, min_bytes: int = 100,
                   chunk_bytes: int = 1 << 20) -> None:
    """Write gzip archives of the frame's payloads into the folder ``path``."""
    rows = segments(with_revisits(df, record_id, payload, min_bytes), record_id, payload, uri, chunk_bytes)
    rows.write.option("lineSep", CRLF).option("compression", "gzip").text(path)


class _Open:
    """A record of which more segments may follow."""

    def __init__(self, head: dict[str, str]):
        self.head, self.sha, self.size, self.chunks = head, hashlib.sha256(), 0, 0


def _records(lines: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header and block of each segment, from the lines of whole archives."""
    for line in lines:
        if not line:
            continue
        if line != VERSION.encode():
            raise ValueError(f"a record should begin here: {line[:80]!r}")
        head = {}
        while header := next(lines):
            name, _, value = header.decode("utf-8", "replace").partition(":")
            head[name.lower()] = value.strip()
        need, got, block = int(head["content-length"]), 0, []
        while True:
            line = next(lines)
            block.append(line)
            got += len(line)
            if got >= need:
                break
            block.append(b"\r\n")  # a line end within the block
            got += 2
        if got != need:
            raise ValueError(f"{head.get('warc-record-id')}: {got} bytes instead of {need}")
        yield head, b"".join(block)


def read_chunks(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The archives as chunk rows: record_id, record_type, refers_to,
    target_uri, declared_digest, chunk_no (from 0), is_last, bytes_so_far,
    digest_so_far (SHA-256 up to the chunk's end) and, if asked for, chunk."""
    schema = CHUNK_SCHEMA + (", chunk binary" if payload else "")
    names = [c.strip().split(" ")[0] for c in schema.split(",")]
    lines = spark.read.option("lineSep", CRLF).text(path)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        out, size, current = {n: [] for n in names}, 0, None
        every = (v or b"" for b in batches for v in b.column(0).to_pylist())
        for head, block in _records(every):
            if head["warc-type"] == "continuation":
                if current is None or int(head["warc-segment-number"]) != current.chunks + 1:
                    raise ValueError(f"{head['warc-record-id']} does not continue the record before it")
            else:
                current = _Open(head)
            current.sha.update(block)
            current.size += len(block)
            last = "warc-segment-number" not in head or "warc-segment-total-length" in head
            row = {"record_id": _plain(current.head["warc-record-id"]), "record_type": current.head["warc-type"],
                   "refers_to": _plain(current.head.get("warc-refers-to")), "target_uri": current.head.get("warc-target-uri"),
                   "declared_digest": current.head.get("warc-payload-digest", "").removeprefix("sha256:"),
                   "chunk_no": current.chunks, "is_last": last, "bytes_so_far": current.size,
                   "digest_so_far": current.sha.copy().hexdigest(), "chunk": block}
            for n in names:
                out[n].append(row[n])
            current.chunks += 1
            size += len(block) * payload + 300
            if size > 4 << 20:
                yield out
                out, size = {n: [] for n in names}, 0
        yield out

    return by_stream(lines, [F.col("value").cast("binary")], schema, parse)


def _plain(uri: str | None) -> str | None:
    """The page's id in a record's URI; null for a page without id."""
    uri = (uri or "").strip("<>")
    return uri.removeprefix(PREFIX) if uri.startswith(PREFIX) else None


def resolved(chunks: DataFrame) -> DataFrame:
    """One row per record: record_id, payload_bytes, payload_digest,
    record_type, refers_to and intact (the digest read is the declared one).
    A revisit takes bytes and digest from the response it refers to."""
    last = stored(chunks.filter("is_last").drop("chunk", "chunk_no", "is_last"))
    response = last.filter("record_type = 'response'")
    own = response.select("record_id", F.col("bytes_so_far").alias("payload_bytes"), F.col("digest_so_far").alias("payload_digest"),
                          "record_type", "refers_to", (F.col("digest_so_far") == F.col("declared_digest")).alias("intact"))
    target = response.groupBy(F.col("record_id").alias("__id"), F.col("digest_so_far").alias("payload_digest")).agg(F.max("bytes_so_far").alias("payload_bytes"))
    revisit = last.filter("record_type = 'revisit'")
    other = revisit.join(target, (revisit.refers_to == F.col("__id")) & (revisit.declared_digest == F.col("payload_digest")), "left")
    return own.unionByName(other.select("record_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                                        F.col("payload_digest").isNotNull().alias("intact")))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive every page, read the archives back, one row per page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    path = write_scratch(spark, lambda p: write_archives(pages, p, "page_id", "html", "url"))
    back = resolved(read_chunks(spark, path, payload=False))
    return back.select(F.col("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       F.col("refers_to").cast("long").alias("refers_to"))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest FROM p),
f AS (SELECT payload_digest AS g, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN g IS NULL OR page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN g IS NULL OR page_id IS NOT DISTINCT FROM first_id THEN NULL ELSE first_id END AS refers_to
FROM d LEFT JOIN f ON d.payload_digest = f.g
"""
