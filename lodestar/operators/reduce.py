"""Reduce tables to the population: semi/anti joins, latest snapshot, allow-lists.

Joins name their keys explicitly as ``[(left, right), ...]`` or a list of
shared names.  The key sets on the right are usually much smaller than the
fact tables; AQE turns such joins into broadcast joins when the runtime
size of the right side is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``
and keeps a shuffle join otherwise.  Explicit ``broadcast`` is only used for
sides with a proven bound (one-row aggregates).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _keys(on) -> list[tuple[str, str]]:
    out = []
    for k in on:
        out.append((k, k) if isinstance(k, str) else (k[0], k[1]))
    return out


def _aligned(right: DataFrame, pairs) -> DataFrame:
    """Right-side keys renamed to the left names and de-duplicated.

    The ``distinct`` is combined map-side and its output is already
    hash-partitioned on the keys, so the join adds no second exchange on
    this side and never shuffles repeated keys.
    """
    return right.select(*[F.col(r).alias(l) for l, r in pairs]).distinct()


def semi_reduce(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Rows of ``df`` whose key appears in ``keys`` (left semi join).

    AQE broadcasts the key set when its runtime size allows it and splits
    skewed partitions of a shuffle join otherwise.
    """
    pairs = _keys(on)
    return df.join(_aligned(keys, pairs), [l for l, _ in pairs], "left_semi")


def anti_reduce(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Rows of ``df`` whose key is absent from ``keys`` (left anti join).

    A NULL key on the left never matches, so such rows are kept.
    """
    pairs = _keys(on)
    return df.join(_aligned(keys, pairs), [l for l, _ in pairs], "left_anti")


def latest_value(df: DataFrame, col: str) -> DataFrame:
    """One-row DataFrame with ``max(col)`` (partial max per task)."""
    return df.agg(F.max(col).alias(col))


def latest_rows(df: DataFrame, col: str) -> DataFrame:
    """Rows where ``col`` equals its maximum over the table.

    The maximum is a one-row aggregate, broadcast into a semi join; on a
    table partitioned by ``col`` this also prunes partitions at run time.
    """
    return df.join(F.broadcast(latest_value(df, col)), col, "left_semi")


def latest_of_files(spark: SparkSession, path: str, col: str) -> DataFrame:
    """Rows of the Parquet table ``path`` at the largest ``col``, found without
    reading data: the maximum comes from the files' footers, or from the folder
    names of a partition column, and the rows by a literal filter, which prunes
    partitions and row groups.

    For columns whose footers hold a maximum that Spark trusts (whole and
    floating numbers, dates); other types are scanned for it, that column alone."""
    meta = spark.newSession()                      # the caller's settings stay as they are
    meta.conf.set("spark.sql.sources.useV1SourceList", "")
    meta.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    top = latest_value(meta.read.parquet(path), col).first()[0]
    table = spark.read.parquet(path)
    return table.filter(F.col(col) == F.lit(top).cast(table.schema[col].dataType))


def top_values(df: DataFrame, col: str, k: int) -> DataFrame:
    """The ``k`` commonest values of ``col`` (ties by value); a top-k report."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
            .orderBy(F.desc("_n"), F.asc(col)).limit(k).select(col))


def allow_list(df: DataFrame, col: str, allowed, value_col: str | None = None) -> DataFrame:
    """Keep rows whose ``col`` is in ``allowed``.

    A Python list becomes a literal ``IN`` (pushed to the scan); a one-column
    DataFrame of any size a semi join.
    """
    if isinstance(allowed, DataFrame):
        return semi_reduce(df, allowed, [(col, value_col or allowed.columns[0])])
    return df.filter(F.col(col).isin(list(allowed)))


def exclude_risk(df: DataFrame, risk: DataFrame, cut: int,
                 keys: Sequence[str] = ("analytic_id", "register_date"),
                 month_col: str = "ddate", decile_col: str = "fraud_decile",
                 charge_col: str = "charge_type", charge: str = "Post-paid") -> DataFrame:
    """Drop rows flagged in the latest risk month with decile <= ``cut``.

    ``cut <= 0`` switches the exclusion off and returns ``df`` unchanged.
    """
    if cut <= 0:
        return df
    r = risk.withColumn(month_col, F.to_date(month_col))
    flagged = (latest_rows(r, month_col)
               .filter((F.col(charge_col) == charge) & (F.col(decile_col) <= cut))
               .select(*keys))
    return anti_reduce(df, flagged, list(keys))


def attach_call_time(df: DataFrame, call_times: DataFrame, key: str = "crm_sub_id",
                     month_col: str = "month_id", value_col: str = "prefer_time",
                     out_col: str = "time2call", default: str = "anytime") -> DataFrame:
    """Best time to call from the latest month of ``call_times``; default when absent."""
    latest = latest_rows(call_times, month_col).select(key, value_col)
    return (df.join(latest, key, "left").withColumnRenamed(value_col, out_col)
            .withColumn(out_col, F.coalesce(F.col(out_col), F.lit(default))))
