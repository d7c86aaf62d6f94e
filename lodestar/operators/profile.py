"""Inspection: table dimensions and key uniqueness, computed on the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dims(df: DataFrame) -> DataFrame:
    """(n_rows, n_cols): a global count with partial counts per task."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_cols", F.lit(len(df.columns)).cast("bigint"))


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


def assert_unique(df: DataFrame, keys) -> DataFrame:
    """Return ``df`` after checking ``keys`` are unique (a join would fan out
    otherwise).  One aggregation with map-side combine; only a single
    offending key is brought to the driver."""
    bad = duplicate_keys(df, keys).limit(1).collect()
    if bad:
        raise ValueError(f"duplicate key {bad[0].asDict()} for {list(keys)}")
    return df
