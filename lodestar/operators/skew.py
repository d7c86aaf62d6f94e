"""Joining group results back to detail rows when one group is huge.

A group statistic has one row per key, but the detail side of the join-back
may hold a third of all rows under a single key; a plain shuffle join puts
them all in one task.  ``salted_join_back`` splits such groups explicitly:

1. a key is "hot" when its group holds more than ``max(rows_per_task, total
   rows / MAX_HOT_KEYS)`` rows, so by arithmetic there are fewer than
   ``MAX_HOT_KEYS`` of them at any input size, every one is split, and the
   list is small enough to broadcast;
2. each detail row of a hot key gets a salt ``pmod(xxhash64(row), buckets)``
   (buckets = ceil(count / rows per task)), other rows salt 0 -- a map-side
   broadcast join, no shuffle;
3. the group side repeats each hot key once per salt (a generator over the
   hot keys only), and the join runs on (keys, salt).

Rows with a NULL key match no group; they are scattered by a hash of the row
instead of meeting in the task of the NULL key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_HOT_KEYS = 10_000
_NULL_SALTS = 1 << 20


def hot_keys(groups: DataFrame, keys: Sequence[str], count_col: str, rows_per_task: int) -> DataFrame:
    """(keys, _buckets) of the groups to split; fewer than ``MAX_HOT_KEYS``."""
    total = groups.agg(F.sum(count_col).alias("_total")).withColumn("_one", F.pmod("_total", F.lit(1)))
    least = F.greatest(F.lit(rows_per_task).cast("long"), F.ceil(F.col("_total") / F.lit(float(MAX_HOT_KEYS))))
    one = F.pmod(F.col(count_col), F.lit(1))              # 0: an equi-join with the one-row total
    return (groups.filter(F.col(count_col) > rows_per_task).select(*keys, count_col, one.alias("_one"))
            .join(F.broadcast(total), "_one").filter(F.col(count_col) > least)
            .select(*keys, F.ceil(F.col(count_col) / least).cast("int").alias("_buckets")))


def salted_join_back(detail: DataFrame, groups: DataFrame, keys: Sequence[str], count_col: str,
                     rows_per_task: int = 2_000_000, salt_cols: Sequence[str] | None = None) -> DataFrame:
    """``detail LEFT JOIN groups USING (keys)`` with hot and NULL keys split.

    ``groups`` must be unique on ``keys`` and carry the group row count in
    ``count_col``.  ``salt_cols`` (default: all detail columns) feed the
    row hash that picks a salt.
    """
    keys = list(keys)
    hot = hot_keys(groups, keys, count_col, rows_per_task)
    row_hash = F.xxhash64(*[F.col(c) for c in (salt_cols or detail.columns)])
    unmatched = F.lit(False)
    for k in keys:
        unmatched = unmatched | F.col(k).isNull()
    salt = (F.when(unmatched, -1 - F.pmod(row_hash, F.lit(_NULL_SALTS)))
            .when(F.col("_buckets").isNull(), F.lit(0))
            .otherwise(F.pmod(row_hash, F.col("_buckets"))).cast("int"))
    tagged = detail.join(F.broadcast(hot), keys, "left").withColumn("_salt", salt).drop("_buckets")
    fanned = (groups.join(F.broadcast(hot), keys, "left")
              .withColumn("_salt", F.explode(F.sequence(
                  F.lit(0), F.coalesce(F.col("_buckets"), F.lit(1)) - 1)))
              .drop("_buckets"))
    return tagged.join(fanned, keys + ["_salt"], "left").drop("_salt")
