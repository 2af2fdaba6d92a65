"""Versioned publishing: all tables of a run become visible at once, or not at all (SNK1, SNK2).

::

    root/versions/<version>/<table>/...    Parquet, never written again
    root/commits/<number>-<version>        an empty file: the version is published

A run writes into a version folder of its own and adds one commit file at its
end; readers follow the commit with the greatest number.  The commit file has
no content, so making it is one step of the file system, also on object stores,
and needs no rename.  A run that fails or is killed leaves no commit: readers
keep the former tables.  A re-run is a new version, so partitions that it does not
have are gone.  Two runs that finish at once may take the same number; the
greater name wins, and both versions are whole.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from shopline.session import _filesystem

DAY_MS = 86_400_000


def _names(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(name, time of change in ms) of what a folder holds; nothing if there is no folder."""
    path, fs = _filesystem(spark, folder)
    if not fs.exists(path):
        return []
    return sorted((s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(path))


def commits(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """(number, version) of the published versions, oldest first."""
    parts = [name.split("-", 1) for name, _ in _names(spark, f"{root}/commits")]
    return [(int(number), version) for number, version in parts]


def current(spark: SparkSession, root: str) -> str:
    """Folder of the published version."""
    published = commits(spark, root)
    if not published:
        raise FileNotFoundError(f"nothing is published under {root}")
    return f"{root}/versions/{published[-1][1]}"


def read_published(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table of the published version.  The version is chosen here, so a query
    keeps reading it while a later one is published."""
    return spark.read.parquet(f"{current(spark, root)}/{table}")


@contextmanager
def new_version(spark: SparkSession, root: str) -> Iterator[str]:
    """``with new_version(...) as folder``: write tables below ``folder``; it is
    published when the block ends, and not if the block raises."""
    version = uuid.uuid4().hex
    yield f"{root}/versions/{version}"
    published = commits(spark, root)
    number = published[-1][0] + 1 if published else 1
    path, fs = _filesystem(spark, f"{root}/commits/{number:012d}-{version}")
    fs.create(path, False).close()


def expire(spark: SparkSession, root: str, *, keep: int = 2, grace_days: float = 7) -> list[str]:
    """Delete all but the last ``keep`` published versions, and version folders
    that no commit names and that began over ``grace_days`` ago (runs that died).
    Returns the deleted versions.  A query over a deleted version fails, so
    ``keep`` must cover the longest reader."""
    if keep < 1:
        raise ValueError("the published version itself must stay")
    published = commits(spark, root)
    gone = []
    for number, version in published[:-keep]:
        # The commit goes first: a version that is named is whole.
        path, fs = _filesystem(spark, f"{root}/commits/{number:012d}-{version}")
        fs.delete(path, False)
        gone.append(version)
    named = {version for _, version in published}
    oldest = time.time() * 1000 - grace_days * DAY_MS
    gone += [name for name, changed in _names(spark, f"{root}/versions") if name not in named and changed < oldest]
    for version in gone:
        path, fs = _filesystem(spark, f"{root}/versions/{version}")
        fs.delete(path, True)
    return gone
