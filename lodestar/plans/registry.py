"""Registered queries: a Spark callable per key, plus DuckDB oracle SQL.

Each query reads the driver tables in ``sf_dir`` (through the stand-in
adapters) and runs over the whole tables.  Floating results that two
engines compute with different summation orders (standard deviations) are
rounded to 2 decimals (a hundredth of a cent) on both sides; sums and means are exact because every
measure is whole cents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def round_cols(df: DataFrame, cols: Iterable[str], digits: int = 6) -> DataFrame:
    cols = set(cols)
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in cols else F.col(c)
                       for c in df.columns])
