"""Exact global ranks and ntiles without a single-partition window.

``ntile(n) OVER (ORDER BY score)`` has no PARTITION BY, so Spark moves
every row into one task.  Here the rows are range-partitioned on
(order columns, tie key) and sorted inside each partition; a row's global
0-based rank is then the number of rows in earlier partitions plus its
position in its own partition.  The per-partition counts are one row per
partition (bounded by the partition count), so broadcasting them is safe.

Positions come from ``monotonically_increasing_id`` (partition index in the
upper bits, row index in the lower 33 bits).  The range-partitioned rows are
checkpointed first, so counts and positions are read from the same files
even if a task is re-run.  The tie key makes the order total, so results
are deterministic and equal SQL ``ntile`` over ``ORDER BY score, key``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_LOW_BITS = 33


def _sort_exprs(order: Sequence[tuple[str, bool]]) -> list[Column]:
    return [F.col(c).asc_nulls_first() if asc else F.col(c).desc_nulls_last()
            for c, asc in order]


def ranged_positions(df: DataFrame, order: Sequence[tuple[str, bool]],
                     num_partitions: int | None = None) -> DataFrame:
    """Rows range-partitioned and sorted by ``order``, stored, with their
    partition number ``_pid`` and 0-based position in it ``_pos_in``.

    Range partitioning reads its input twice, for the bounds and for the
    rows, so the input is stored first and runs once; both reads are scans.
    The checkpoint fixes the positions: every later read sees the same rows
    in the same places, whatever executors are lost."""
    from lodestar.session import ensure_checkpoint_dir, shared_dir
    from lodestar.sources.tables import checkpoint_table
    spark = df.sparkSession
    df = checkpoint_table(df, shared_dir(spark, f"rank-input-{uuid.uuid4().hex[:12]}"))
    n_parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    exprs = _sort_exprs(order)
    ensure_checkpoint_dir(spark)              # the shared spark.checkpoint.dir
    ranged = df.repartitionByRange(n_parts, *exprs).sortWithinPartitions(*exprs).checkpoint(eager=True)
    return (ranged.withColumn("_mid", F.monotonically_increasing_id())
            .withColumn("_pid", F.shiftrightunsigned(F.col("_mid"), _LOW_BITS))
            .withColumn("_pos_in", F.col("_mid").bitwiseAND(F.lit((1 << _LOW_BITS) - 1))).drop("_mid"))


def global_rank(df: DataFrame, order: Sequence[tuple[str, bool]], out_col: str = "_rank",
                num_partitions: int | None = None) -> DataFrame:
    """Add the 0-based global rank under ``order`` ([(column, ascending)]),
    plus ``_n`` = total rows.  Include a unique key last in ``order``."""
    pos = ranged_positions(df, order, num_partitions)
    counts = pos.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    # One row per partition: ordering them in one task is bounded by n_parts.
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(w), F.lit(0)))
               .withColumn("_n", F.sum("_cnt").over(Window.partitionBy(F.lit(1))))
               .select("_pid", "_off", "_n"))
    ranked = pos.join(F.broadcast(offsets), "_pid")
    return (ranked.withColumn(out_col, F.col("_off") + F.col("_pos_in"))
            .drop("_pid", "_pos_in", "_off"))


def ntile_of_rank(rank: Column, n: Column, buckets: int) -> Column:
    """SQL ntile from a 0-based rank among ``n`` rows.

    With s = n div b and g = n mod b the first g buckets hold s + 1 rows.
    """
    b = F.lit(buckets)
    s = F.floor(n / b).cast("long")
    g = (n % b).cast("long")
    big = g * (s + 1)
    first = F.floor(rank / (s + 1)) + 1
    rest = F.floor((rank - big) / F.greatest(s, F.lit(1))) + g + 1
    return F.when(rank < big, first).otherwise(rest).cast("long")


def add_ntiles(df: DataFrame, order: Sequence[tuple[str, bool]], tiles: dict[str, int],
               **kw) -> DataFrame:
    """Add one ntile column per ``{name: buckets}`` in a single ranking pass."""
    ranked = global_rank(df, order, **kw)
    out = ranked
    for name, b in tiles.items():
        out = out.withColumn(name, ntile_of_rank(F.col("_rank"), F.col("_n"), b))
    return out.drop("_rank", "_n")


def window_ntiles(df: DataFrame, order: Sequence[tuple[str, bool]], tiles: dict[str, int]) -> DataFrame:
    """The single-task ``ntile`` window form (bench comparison and tests)."""
    w = Window.orderBy(*_sort_exprs(order))
    out = df
    for name, b in tiles.items():
        out = out.withColumn(name, F.ntile(b).over(w).cast("long"))
    return out
