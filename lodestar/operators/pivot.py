"""Two-level usage rollup and long -> wide pivots with frozen column values.

One ``groupBy().pivot(values).agg(m1, m2, ...)`` replaces one pivot per
metric followed by full outer joins on the same key: a single shuffle
instead of one per metric plus one per join.  Pivot values are always
given explicitly, so the column set is fixed (a value missing from the data
still gets its column, filled with 0) and Spark skips the distinct-values
job it would otherwise run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.calendar import DAY_PERIODS, WEEKDAY_LABELS, day_period, weekday_label

_AGG = {"sum": F.sum, "avg": F.avg, "mean": F.avg, "max": F.max, "min": F.min,
        "first": F.first}

# Fixed values (must equal the reference's names): hourly measure -> daily
# sum name -> mean name.
USAGE_MEASURES = [
    ("data_vol_kb", "sum_data_vol", "mean_data_vol"),
    ("data_usg_minute", "sum_data_min", "mean_data_min"),
    ("voice_out_minute", "sum_voice_out", "mean_voice_out"),
    ("voice_in_minute", "sum_voice_in", "mean_voice_in"),
]
# Pivot order of the four usage means in the wide table.
USAGE_PIVOT_ORDER = ["mean_data_vol", "mean_data_min", "mean_voice_in", "mean_voice_out"]
# Application measures: (input, aggregate, column suffix).
APP_MEASURES = [("duration_sec", "sum", "duration"), ("time_cnt", "sum", "count"),
                ("vol_sum_kb", "sum", "vol")]

WEEKDAY_PERIODS = sorted(f"{w}_{p}" for w in WEEKDAY_LABELS for p in DAY_PERIODS)


def qcol(name: str):
    """Column by exact name (names may start with digits or hold dots)."""
    return F.col(f"`{name}`")


def zero_fill(col: str, dtype: str):
    """NULL and NaN -> 0, like ``na.fill(0)``."""
    c = qcol(col)
    if dtype in ("double", "float"):
        c = F.nanvl(c, F.lit(0.0))
    return F.coalesce(c, F.lit(0).cast(dtype))


def usage_periods(usage: DataFrame, id_col: str = "analytic_id", day_col: str = "date_id",
                  hour_col: str = "hour_id", month_src: str = "ddate") -> DataFrame:
    """Tag hourly rows with day, weekday label, day period and month end."""
    return (usage.filter(F.col(hour_col).between(0, 23))
            .withColumn("date", F.to_date(day_col))
            .withColumn("wday", weekday_label("date"))
            .withColumn("period", day_period(hour_col))
            .withColumn("month_id", F.last_day(month_src)))


def two_stage_mean(usage: DataFrame, keys: Sequence[str] = ("analytic_id", "wday", "period", "month_id"),
                   day_col: str = "date", measures=USAGE_MEASURES, deal_by: Sequence[str] = ()) -> DataFrame:
    """Sum per day, then mean of the daily sums per (keys).

    ``deal_by``, a subset of the keys, deals the daily sums once by those
    columns; the means and any later grouping that holds them then need no
    exchange of their own.

    Days without any row are not counted as zero.  Both levels aggregate
    map-side first, so a subscriber with a huge share of rows is reduced in
    every task before the shuffle.
    """
    daily = usage.groupBy(*keys, day_col).agg(
        *[F.sum(src).alias(s) for src, s, _ in measures])
    if deal_by:
        daily = daily.repartition(*deal_by)
    return daily.groupBy(*keys).agg(*[F.avg(s).alias(m) for _, s, m in measures])


def wide_pivot(df: DataFrame, keys: Sequence[str], pivot_col: str, values: Sequence[str],
               measures: Sequence[tuple[str, str, str]], fill=0.0) -> DataFrame:
    """Long -> wide: columns ``{value}_{suffix}`` for every (value, measure).

    ``measures`` = [(input column, aggregate, suffix)].  Output columns are
    grouped by measure, then by value, in the order given; ``fill`` replaces
    empty cells (None keeps them NULL).
    """
    values = list(values)
    aggs = [_AGG[fn](qcol(src)).alias(suffix) for src, fn, suffix in measures]
    wide = df.groupBy(*keys).pivot(pivot_col, values).agg(*aggs)
    out = [F.col(k) for k in keys]
    names = []
    for _, _, suffix in measures:
        for v in values:
            spark_name = str(v) if len(measures) == 1 else f"{v}_{suffix}"
            name = f"{v}_{suffix}"
            names.append(name)
            out.append(qcol(spark_name).alias(name))
    wide = wide.select(*out)
    if fill is None:
        return wide
    types = dict(wide.dtypes)
    return wide.select(*[F.col(k) for k in keys],
                       *[zero_fill(n, types[n]).alias(n) for n in names])


def usage_pivot(usage: DataFrame, id_col: str = "analytic_id") -> DataFrame:
    """Hourly usage -> one row per (subscriber, month) with 7 x 4 x 4 means."""
    tagged = usage_periods(usage, id_col=id_col)
    # at most 31 days x 28 periods a subscriber and month: dealing by both is even
    means = two_stage_mean(tagged, keys=(id_col, "wday", "period", "month_id"), deal_by=(id_col, "month_id"))
    means = means.withColumn("wday_period", F.concat_ws("_", "wday", "period"))
    order = {m: i for i, m in enumerate(USAGE_PIVOT_ORDER)}
    measures = sorted([(m, "avg", m) for _, _, m in USAGE_MEASURES], key=lambda t: order[t[0]])
    return wide_pivot(means, [id_col, "month_id"], "wday_period", WEEKDAY_PERIODS, measures)


def app_pivot(apps: DataFrame, app_values: Sequence[str], id_col: str = "analytic_id",
              month_col: str = "last_date", app_col: str = "application") -> DataFrame:
    """Application usage -> ``{app}_duration``, ``{app}_count``, ``{app}_vol``.

    ``app_values`` is the frozen application list (the training list when
    scoring); rows of other applications are filtered out before the shuffle.
    """
    a = (apps.filter(F.col(app_col).isin(list(app_values)))
         .withColumn("vol_sum_kb", F.col("volume_ul_kb") + F.col("volume_dw_kb")))
    return wide_pivot(a, [id_col, month_col], app_col, app_values, APP_MEASURES)
