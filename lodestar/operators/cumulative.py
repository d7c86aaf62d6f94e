"""Running sums within groups, without a group in one task.

The points are range-partitioned by (group, order) and summed within each
partition; the sums of a group's earlier partitions are added from one row per
(partition, group).  Ranges cut large groups anywhere, so one group may be the
whole table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestar.operators.rank import ranged_positions


def cumulative(points: DataFrame, group: Sequence[str], order: Sequence[tuple[str, bool]], sums: Sequence[str]) -> DataFrame:
    """``points`` (unique by group and order) with ``{s}_upto``, the sum of ``s``
    from the group's first point to this one, and ``{s}_all``, the group's.

    The broadcast side has a row per partition and one more per group at
    most; groups are things a model has (features, trees), not data."""
    group, sums = list(group), list(sums)
    pos = ranged_positions(points, [*((g, True) for g in group), *order])
    inside = Window.partitionBy("_pid", *group).orderBy("_pos_in").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    parts = pos.groupBy("_pid", *group).agg(*[F.sum(s).alias(f"_{s}") for s in sums])
    parts = parts.select("_pid", *group, *[F.coalesce(F.sum(f"_{s}").over(before), F.lit(0)).alias(f"_{s}_0") for s in sums],
                         *[F.sum(f"_{s}").over(whole).alias(f"{s}_all") for s in sums])
    run = pos.withColumns({f"_{s}_1": F.sum(s).over(inside) for s in sums}).join(F.broadcast(parts), ["_pid", *group])
    return (run.withColumns({f"{s}_upto": F.col(f"_{s}_0") + F.col(f"_{s}_1") for s in sums})
            .drop("_pid", "_pos_in", *[f"_{s}_{i}" for s in sums for i in (0, 1)]))
