"""The life of intermediate tables.

``with scratch(spark):`` drops every intermediate that is stored inside it, by
``intermediate``, when it ends, also when it fails.  A flow puts its steps
inside one and leaves its results outside; scopes may be nested, each drops
its own.  Folders go through the Hadoop file system, so they may be in any store.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

_OPEN: ContextVar[tuple[list[str], ...]] = ContextVar("scratch", default=())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    folders: list[str] = []
    token = _OPEN.set((*_OPEN.get(), folders))
    try:
        yield
    finally:
        _OPEN.reset(token)
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        for f in folders:
            p = hadoop.Path(f)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def intermediate(path: str) -> str:
    """``path``, to be dropped when the innermost open scope ends (kept if none is open)."""
    if _OPEN.get():
        _OPEN.get()[-1].append(path)
    return path
