"""The reference's literal plan shapes, kept for the bench and equivalence tests.

* one pivot per metric, merged by full outer joins
* one left join per history table and lag
* ``ntile`` over a window without PARTITION BY (one task)
"""

from __future__ import annotations

from functools import reduce as _fold

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.operators import lags, pivot, rank


def usage_pivot_literal(usage: DataFrame, id_col: str = "analytic_id") -> DataFrame:
    tagged = pivot.usage_periods(usage, id_col=id_col)
    means = pivot.two_stage_mean(tagged, keys=(id_col, "wday", "period", "month_id"))
    means = means.withColumn("wday_period", F.concat_ws("_", "wday", "period"))
    keys = [id_col, "month_id"]
    parts = [pivot.wide_pivot(means, keys, "wday_period", pivot.WEEKDAY_PERIODS, [(m, "avg", m)])
             for m in pivot.USAGE_PIVOT_ORDER]
    return _fold(lambda a, b: a.join(b, keys, "full"), parts)


def lags_literal(base, histories, **kw) -> DataFrame:
    return lags.month_lags_literal(base, histories, **kw)


def ntiles_literal(df, order, tiles) -> DataFrame:
    return rank.window_ntiles(df, order, tiles)
