"""Stored forms of derived data, written once per version of the files they come from.

A version is the list of the source files with their lengths and times, so a
file that was added or changed makes a new version and the store is written
anew; nothing is read from an older one. Stores belong to the running
application and lie in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import SparkSession

_KNOWN: dict[tuple, str] = {}


def files_of(spark: SparkSession, path: str) -> tuple:
    """(path, length, time) of all files under ``path``, from the file system's listing."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = where.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(where, True)
    out = []
    while listed.hasNext():
        f = listed.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))


def once(spark: SparkSession, name: str, sources: Iterable[str], build: Callable[[], str]) -> str:
    """The place (path or table) that ``build()`` wrote for this version of ``sources``."""
    version = tuple(files_of(spark, s) for s in sources)
    key = (spark.sparkContext.applicationId, name, version)
    if key not in _KNOWN:
        _KNOWN[key] = build()
    return _KNOWN[key]
