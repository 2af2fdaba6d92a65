"""Replacing a database table as a whole (SNK3).

The rows go into a staging table of the run's own, by executors in parallel;
its rows are counted against those that were sent, and then it takes the place of
the old table in one transaction.  Until that commit the old table is as it was,
whatever fails: a partition, the driver, the count.  A task that is tried again
after its rows were committed would double them; the count finds that, and the
replacement is refused.

Needs a database whose DDL is transactional; ``RENAME`` names those that are
known, with their statement.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from shopline.sinks import writers

#: Statement that renames a table, by the database's name in the URL.
RENAME = {"derby": "RENAME TABLE {old} TO {new}", "postgresql": "ALTER TABLE {old} RENAME TO {new}"}


def database(url: str) -> str:
    """The database's name in a JDBC URL."""
    return url.split(":", 2)[1] if url.startswith("jdbc:") else ""


@contextmanager
def _transaction(spark: SparkSession, url: str, properties: dict[str, str]) -> Iterator:
    """A connection of the driver's; what is done in the block is committed at its end or not at all."""
    jvm = spark._jvm
    if "driver" in properties:
        jvm.java.lang.Class.forName(properties["driver"])
    given = jvm.java.util.Properties()
    for k, v in properties.items():
        given.setProperty(k, v)
    conn = jvm.java.sql.DriverManager.getConnection(url, given)
    try:
        conn.setAutoCommit(False)
        try:
            yield conn
        except BaseException:
            conn.rollback()
            raise
        conn.commit()
    finally:
        conn.close()


def _exists(conn, table: str) -> bool:
    meta = conn.getMetaData()
    if meta.storesUpperCaseIdentifiers():
        table = table.upper()
    elif meta.storesLowerCaseIdentifiers():
        table = table.lower()
    schema, _, name = table.rpartition(".")
    return meta.getTables(None, schema or conn.getSchema(), name, None).next()


def replace_table(df: DataFrame, url: str, table: str, *, properties: dict[str, str] | None = None,
                  batch_size: int = 10_000, num_partitions: int = writers.MAX_CONNECTIONS) -> int:
    """Replace ``table`` by the rows of ``df``, or leave it as it is and raise; returns the number of rows.

    An empty frame makes an empty table; a table that isn't there is made; the new table has
    the columns of ``df``.  ``df`` is read twice, to count and to write, so it should be
    a stored table, whose rows are counted from its files' footers.  (Rows that a JDBC
    writer sends are not seen by ``DataFrame.observe``.)
    """
    kind = database(url)
    if kind not in RENAME:
        raise ValueError(f"tables of {kind or url!r} can't be replaced in one transaction; known: {sorted(RENAME)}")
    spark, properties = df.sparkSession, properties or {}
    staging = f"{table}_{uuid.uuid4().hex[:12]}"
    sent = df.count()
    try:
        writers.write_jdbc(df, url, staging, properties=properties, batch_size=batch_size, num_partitions=num_partitions)
        with _transaction(spark, url, properties) as conn:
            statement = conn.createStatement()
            found = statement.executeQuery(f"SELECT COUNT(*) FROM {staging}")
            found.next()
            stored = found.getLong(1)
            found.close()
            if stored != sent:
                raise RuntimeError(f"{table}: {sent} rows sent, {stored} stored; the table was left as it was")
            if _exists(conn, table):
                statement.execute(f"DROP TABLE {table}")
            statement.execute(RENAME[kind].format(old=staging, new=table.rpartition(".")[2]))
        return sent
    except BaseException:
        with _transaction(spark, url, properties) as conn:
            if _exists(conn, staging):
                conn.createStatement().execute(f"DROP TABLE {staging}")
        raise
