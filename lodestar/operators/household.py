"""Household group statistics joined back to members (the monthly mart).

Group statistics use ``groupBy().agg()``: Spark computes partial
aggregates map-side, so a household holding a third of all members costs
one small partial row per task, not one giant task.  They are joined back
to members with a left equi-join rather than a window: a window would sort
every member of the hot household in one task, the join lets AQE split the
skewed member side.  NULL household keys form a group in the aggregate but
never match in the join (members without a household get NULL statistics).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.operators.skew import salted_join_back

HOUSEHOLD_KEYS = ("home_analytic_id", "geo_home_shape_id")
MEMBER_KEYS = ("analytic_id", "register_date")

# Fixed values (must equal the reference's output names): statistic name
# pattern, statistic, member column -- in the reference's order.
HOUSEHOLD_STATS = [
    ("total_household_arpu", "sum", "arpu"),
    ("average_household_arpu", "avg", "arpu"),
    ("max_household_arpu", "max", "arpu"),
    ("min_household_arpu", "min", "arpu"),
    ("std_household_arpu", "stddev", "arpu"),
    ("total_household_voice_minute", "sum", "total_voice_minute"),
    ("average_household_voice_minute", "avg", "total_voice_minute"),
    ("max_household_voice_minute", "max", "total_voice_minute"),
    ("min_household_voice_minute", "min", "total_voice_minute"),
    ("std_household_voice_minute", "stddev", "total_voice_minute"),
    ("total_household_data_usage", "sum", "total_data_usage"),
    ("average_household_data_usage", "avg", "total_data_usage"),
    ("max_household_data_usage", "max", "total_data_usage"),
    ("min_household_data_usage", "min", "total_data_usage"),
    ("std_household_data_usage", "stddev", "total_data_usage"),
    ("average_household_age", "avg", "ma_age"),
    ("max_household_age", "max", "ma_age"),
    ("min_household_age", "min", "ma_age"),
    ("std_household_age", "stddev", "ma_age"),
    ("average_household_service_month", "avg", "service_month"),
    ("max_household_service_month", "max", "service_month"),
    ("min_household_service_month", "min", "service_month"),
    ("std_household_service_month", "stddev", "service_month"),
    ("household_person_count", "count", None),
]
HOUSEHOLD_COLS = [name for name, _, _ in HOUSEHOLD_STATS]

_AGG = {
    "sum": F.sum, "avg": F.avg, "max": F.max, "min": F.min,
    "stddev": F.stddev_samp,  # sample sd: NULL for a one-member household
}


def household_stats(members: DataFrame, keys: Sequence[str] = HOUSEHOLD_KEYS,
                    stats=HOUSEHOLD_STATS) -> DataFrame:
    """One row per household key with the group statistics."""
    aggs = [F.count(F.lit(1)).alias(name) if fn == "count" else _AGG[fn](col).alias(name)
            for name, fn, col in stats]
    return members.groupBy(*keys).agg(*aggs)


def household_features(members: DataFrame, keys: Sequence[str] = HOUSEHOLD_KEYS,
                       member_cols: Sequence[str] = MEMBER_KEYS,
                       partition_cols: Sequence[str] = (),
                       stats=HOUSEHOLD_STATS, dedupe: bool = True,
                       rows_per_task: int | None = 2_000_000) -> DataFrame:
    """Members with their household statistics attached.

    ``partition_cols`` (e.g. the month) are added to the group and join
    keys, so one call builds the mart for every month at once.  Exact
    duplicate member rows are dropped first (``dedupe``).  Households with
    more than ``rows_per_task`` members are joined back in salted slices
    (``skew.salted_join_back``); ``None`` leaves skew to AQE alone.
    """
    group_keys = list(partition_cols) + list(keys)
    src = members.distinct() if dedupe else members
    names = [name for name, _, _ in stats]
    count_col = next((n for n, fn, _ in stats if fn == "count"), None)
    stats_df = household_stats(src, group_keys, stats)
    left = src.select(*member_cols, *keys, *partition_cols)
    if rows_per_task and count_col:
        joined = salted_join_back(left, stats_df, group_keys, count_col, rows_per_task,
                                  salt_cols=list(member_cols))
    else:
        joined = left.join(stats_df, on=group_keys, how="left")
    return joined.select(*member_cols, *keys, *names, *partition_cols)


def household_month(members: DataFrame, month, month_col: str = "ddate",
                    **kw) -> DataFrame:
    """The mart rows for one month end: filter (pushed to the scan) then build."""
    one = members.filter(F.col(month_col) == F.lit(month)).drop(month_col)
    return household_features(one, **kw).withColumn(month_col, F.lit(month))
