"""A month-partitioned table whose appends survive a crash.

Layout of a table folder:

* ``<month_col>=<month>/``: the rows of a month;
* ``_months/<month>``: its marker, a text file with the number of rows;
* ``_staging-<id>/``: rows of an append that hasn't published them yet.

An append writes all its rows to a staging folder first, counts them per
month, and publishes month by month: the folder is renamed into place, then
its marker is written.  A month counts as stored when its marker exists; a
month folder without one is what a dead append left behind, and the next append
that brings the month replaces it.  Readers (``read_months``) take
marked months only, so they never see a part of a month, whatever the store's
rename does.  Names that start with ``_`` are hidden from Spark's own readers.

One append at a time writes to a table; leftover staging folders are dropped
by the next one.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARKERS, STAGING = "_months", "_staging-"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path exists, in whatever file system it names.  Errors other
    than absence (permissions, an unreachable store) raise."""
    return _fs(spark, path).exists(_path(spark, path))


def _names(spark: SparkSession, path: str) -> list[str]:
    return [f.getPath().getName() for f in _fs(spark, path).listStatus(_path(spark, path))]


def _folders(spark: SparkSession, target: str, month_col: str) -> list[str]:
    """Months with a folder, marked or not."""
    fs = _fs(spark, target)
    if not fs.getFileStatus(_path(spark, target)).isDirectory():
        raise ValueError(f"{target} is not a month-partitioned table")
    names = [f.getPath().getName() for f in fs.listStatus(_path(spark, target)) if f.isDirectory()]
    odd = [n for n in names if not n.startswith((f"{month_col}=", "_", "."))]
    if odd:
        raise ValueError(f"{target} is not partitioned by {month_col}: it holds {odd[0]}")
    return [n.split("=", 1)[1] for n in names if n.startswith(f"{month_col}=")]


def _mark(spark: SparkSession, target: str, month: str, rows: int) -> None:
    out = _fs(spark, target).create(_path(spark, f"{target}/{MARKERS}/{month}"), True)
    out.write(bytearray(str(rows).encode()))
    out.close()


def marked(spark: SparkSession, target: str, month_col: str = "ddate") -> list[str]:
    """Stored months, from the markers; no data file is opened."""
    folders = _folders(spark, target, month_col)
    if not path_exists(spark, f"{target}/{MARKERS}"):
        if folders:
            raise ValueError(f"{target} has months but no markers: call adopt_months once if they are whole")
        return []
    found = set(_names(spark, f"{target}/{MARKERS}"))
    lost = sorted(m for m in found if not m.startswith((".", "_")) and m not in folders)
    if lost:
        raise ValueError(f"{target}: month {lost[0]} is marked, but its folder is gone")
    return sorted(m for m in folders if m in found)


def stored_months(spark: SparkSession, target: str, month_col: str = "ddate") -> DataFrame | None:
    """Months stored in the table (None if there is no table).

    Only an absent path counts as an empty table; one that can't be read
    raises, so a broken mart never has its months appended again."""
    if not path_exists(spark, target):
        return None
    months = [(date.fromisoformat(m),) for m in marked(spark, target, month_col)]
    return spark.createDataFrame(months, f"{month_col} date")


def read_months(spark: SparkSession, target: str, month_col: str = "ddate") -> DataFrame:
    """The rows of all stored months (the list is as long as the calendar)."""
    months = marked(spark, target, month_col)
    if not months:
        raise ValueError(f"{target} holds no month")
    return spark.read.option("basePath", target).parquet(*[f"{target}/{month_col}={m}" for m in months])


def latest_month(spark: SparkSession, target: str, month_col: str = "ddate") -> DataFrame:
    """The rows of the latest stored month: its name comes from the markers, so
    no data is read to find it and only its folder is listed and scanned."""
    months = marked(spark, target, month_col)
    if not months:
        raise ValueError(f"{target} holds no month")
    rows = spark.read.option("basePath", target).parquet(f"{target}/{month_col}={months[-1]}")
    return rows.filter(F.col(month_col) == F.lit(date.fromisoformat(months[-1])))


def adopt_months(spark: SparkSession, target: str, month_col: str = "ddate") -> int:
    """Mark the months of a table that was written without markers."""
    months = _folders(spark, target, month_col)
    counts = {str(r[0]): r[1] for r in spark.read.parquet(target).groupBy(month_col).count().collect()} if months else {}
    _fs(spark, target).mkdirs(_path(spark, f"{target}/{MARKERS}"))
    for m in months:
        _mark(spark, target, m, counts.get(m, 0))
    return len(months)


def _publish(spark: SparkSession, staging: str, target: str, month_col: str, month: str, rows: int) -> None:
    """Put a staged month in place of whatever its folder holds, then mark it."""
    fs = _fs(spark, target)
    fs.delete(_path(spark, f"{target}/{MARKERS}/{month}"), False)
    folder = _path(spark, f"{target}/{month_col}={month}")
    fs.delete(folder, True)
    if not fs.rename(_path(spark, f"{staging}/{month_col}={month}"), folder):
        raise OSError(f"month {month} of {target} could not be moved into place")
    _mark(spark, target, month, rows)


def append_months(new_rows: DataFrame, target: str, month_col: str = "ddate", replace: bool = False) -> int:
    """Idempotent append; returns the number of new months.

    Months already stored are skipped, or replaced with ``replace``.  Unlike a
    "newer than the latest month" guard this allows backfills and works on
    an empty or missing target.  The month list is tiny (one row per stored
    month), so broadcasting it is bounded by the calendar.  ``new_rows`` is
    computed once, by the staging write.
    """
    spark = new_rows.sparkSession
    before = stored_months(spark, target, month_col)
    rows = new_rows
    if before is not None and not replace:
        rows = rows.join(F.broadcast(before), month_col, "left_anti")
    fs = _fs(spark, target)
    fs.mkdirs(_path(spark, f"{target}/{MARKERS}"))
    for name in _names(spark, target):
        if name.startswith(STAGING):
            fs.delete(_path(spark, f"{target}/{name}"), True)
    staging = f"{target}/{STAGING}{uuid.uuid4().hex[:12]}"
    rows.write.partitionBy(month_col).parquet(staging)
    staged = [n.split("=", 1)[1] for n in _names(spark, staging) if n.startswith(f"{month_col}=")]
    known = set(marked(spark, target, month_col))
    if staged:
        found = (spark.read.schema(rows.schema).option("basePath", staging)
                 .parquet(*[f"{staging}/{month_col}={m}" for m in staged]))
        counts = {str(r[0]): r[1] for r in found.groupBy(month_col).count().collect()}      # footers only
        if "__HIVE_DEFAULT_PARTITION__" in staged:
            raise ValueError(f"rows without a {month_col} can't be stored")
        for m in sorted(staged):
            _publish(spark, staging, target, month_col, m, counts[m])
    fs.delete(_path(spark, staging), True)
    return len(set(staged) - known)
