"""Table reads and writes: scans, value lists, checkpoints, appends, exports, run log."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.sources.months import append_months, latest_month, path_exists, read_months, stored_months  # noqa: F401
from lodestar.sources.scratch import intermediate


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy scan of one Parquet table; projections and filters reach the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# -- small value lists (app allow-lists) ------------------------------------

def read_value_list(spark: SparkSession, path: str, column: str) -> DataFrame:
    """Read a one-column CSV list with an explicit schema (no inference pass)."""
    schema = T.StructType([T.StructField(column, T.StringType())])
    return (spark.read.schema(schema).option("header", True).csv(path)
            .filter(F.col(column).isNotNull()).distinct())


def write_value_list(values: DataFrame, column: str, path: str, single_file: bool = False) -> None:
    """Write the distinct values of ``column`` as a CSV list, in parts unless a
    receiver takes ``single_file`` only (a list that one task can write)."""
    rows = values.select(column).distinct()
    (rows.repartition(1) if single_file else rows).write.mode("overwrite").option("header", True).csv(path)


# -- lineage cuts ------------------------------------------------------------

def checkpoint_table(df: DataFrame, path: str, partition_by: Iterable[str] = (), keep: bool = False) -> DataFrame:
    """Write ``df`` as Parquet under a shared path and read it back.  An open
    ``scratch`` scope drops the folder at its end, unless it is to be kept.

    This cuts the lineage of a long feature plan, so later stages (model
    fit, scoring) re-read files instead of recomputing joins, and a lost
    executor only costs the re-read of its files.
    """
    writer = df.write.mode("overwrite")
    path = path if keep else intermediate(path)
    cols = list(partition_by)
    if cols:
        writer = writer.partitionBy(*cols)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


# -- delimited files ---------------------------------------------------------

def read_delimited(spark: SparkSession, path: str, schema: T.StructType,
                   sep: str = ",") -> DataFrame:
    """Delimited read with a given schema (no inference job)."""
    return spark.read.schema(schema).option("header", True).option("sep", sep).csv(path)


def write_scores(scores: DataFrame, path: str) -> None:
    """Distributed score sink: one CSV part per partition."""
    scores.write.mode("overwrite").option("header", True).csv(path)


def export_path(out_dir: str, as_of) -> str:
    as_of = as_of if isinstance(as_of, (date, datetime)) else date.fromisoformat(str(as_of))
    return f"{out_dir.rstrip('/')}/post_{as_of.strftime('%Y%m')}"


def export_list(campaign: DataFrame, out_dir: str, as_of, sep: str = "|", single_file: bool = False) -> str:
    """Write the campaign list to a ``post_yyyyMM`` folder of delimited parts.

    ``single_file`` writes one part in one task, for receivers that take one
    file only: ``repartition(1)`` rather than ``coalesce(1)``, so the plan
    above it stays parallel.
    """
    path = export_path(out_dir, as_of)
    rows = campaign.repartition(1) if single_file else campaign
    rows.write.mode("overwrite").option("header", True).option("sep", sep).option("dateFormat", "yyyy-MM-dd").csv(path)
    return path


# -- run log -----------------------------------------------------------------

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("logged_at", T.TimestampType()),
    T.StructField("kind", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])


def run_log_rows(params: dict | None = None, metrics: dict | None = None,
                 artifacts: dict | None = None, run_id: str | None = None) -> list[tuple]:
    """Long rows (run_id, time, kind, key, value) for params, metrics and artifacts."""
    run_id = run_id or uuid.uuid4().hex
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    out = []
    for kind, d in (("param", params), ("metric", metrics), ("artifact", artifacts)):
        for k, v in (d or {}).items():
            out.append((run_id, now, kind, str(k), str(v)))
    return out


def write_run_log(spark: SparkSession, rows: list[tuple], path: str) -> DataFrame:
    """Append run-log rows (a handful per run) to a Parquet table."""
    df = spark.createDataFrame(rows, RUN_LOG_SCHEMA)
    df.write.mode("append").parquet(path)
    return df
