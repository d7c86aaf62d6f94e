"""Three-month averages and slopes from the current value and two lags.

Both are generated expressions over (output, base) pairs, evaluated in one
``select`` (no chain of ``withColumn``).  A slope's denominator can be 0;
``try_divide`` yields NULL there (ANSI mode would raise) and the final fill
turns it into 0, as does a missing month (lags are zero-filled before).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.values import safe_ratio
from lodestar.operators.pivot import qcol

# Fixed values (must equal the reference's feature names): average name <-
# base column, in the reference's order.
AVG_FEATURES = [
    ("avg_gprs", "norms_net_revenue_gprs"),
    ("avg_vas", "norms_net_revenue_vas"),
    ("avg_voice", "norms_net_revenue_voice"),
    ("avg_total_hh_arpu", "total_household_arpu"),
    ("avg_average_hh_arpu", "average_household_arpu"),
    ("avg_max_hh_arpu", "max_household_arpu"),
    ("avg_min_hh_arpu", "min_household_arpu"),
    ("avg_std_hh_arpu", "std_household_arpu"),
    ("avg_average_hh_voice_minute", "average_household_voice_minute"),
    ("avg_max_hh_voice_minute", "max_household_voice_minute"),
    ("avg_min_hh_voice_minute", "min_household_voice_minute"),
    ("avg_std_hh_voice_minute", "std_household_voice_minute"),
    ("avg_average_hh_data_usage", "average_household_data_usage"),
    ("avg_max_hh_data_usage", "max_household_data_usage"),
    ("avg_min_hh_data_usage", "min_household_data_usage"),
    ("avg_std_hh_data_usage", "std_household_data_usage"),
    ("avg_average_hh_age", "average_household_age"),
    ("avg_max_hh_age", "max_household_age"),
    ("avg_min_hh_age", "min_household_age"),
    ("avg_std_hh_age", "std_household_age"),
    ("avg_average_hh_service_month", "average_household_service_month"),
    ("avg_max_hh_service_month", "max_household_service_month"),
    ("avg_min_hh_service_month", "min_household_service_month"),
    ("avg_std_hh_service_month", "std_household_service_month"),
    ("avg_hh_person_count", "household_person_count"),
    ("avg_data_traffic_subs_mb", "data_traffic_subs_mb"),
    ("avg_mou_ic_total", "mou_ic_total"),
    ("avg_mou_og_total", "mou_og_total"),
    ("avg_distinct_out_number", "distinct_out_number"),
]

# Fixed values (must equal the reference's feature names): slope name <-
# base column, in the reference's order.
SLOPE_FEATURES = [
    ("slope_net_rev", "norms_net_revenue_avg_3mth_p0_p2"),
    ("slope_gprs", "norms_net_revenue_gprs"),
    ("slope_vas", "norms_net_revenue_vas"),
    ("slope_voice", "norms_net_revenue_voice"),
    ("slope_total_household_arpu", "total_household_arpu"),
    ("slope_average_household_arpu", "average_household_arpu"),
    ("slope_max_household_arpu", "max_household_arpu"),
    ("slope_min_household_arpu", "min_household_arpu"),
    ("slope_std_household_arpu", "std_household_arpu"),
    ("slope_total_household_voice_minute", "total_household_voice_minute"),
    ("slope_average_household_voice_minute", "average_household_voice_minute"),
    ("slope_max_household_voice_minute", "max_household_voice_minute"),
    ("slope_min_household_voice_minute", "min_household_voice_minute"),
    ("slope_std_household_voice_minute", "std_household_voice_minute"),
    ("slope_total_household_data_usage", "total_household_data_usage"),
    ("slope_average_household_data_usage", "average_household_data_usage"),
    ("slope_max_household_data_usage", "max_household_data_usage"),
    ("slope_min_household_data_usage", "min_household_data_usage"),
    ("slope_std_household_data_usage", "std_household_data_usage"),
    ("slope_average_household_age", "average_household_age"),
    ("slope_max_household_age", "max_household_age"),
    ("slope_min_household_age", "min_household_age"),
    ("slope_std_household_age", "std_household_age"),
    ("slope_average_household_service_month", "average_household_service_month"),
    ("slope_max_household_service_month", "max_household_service_month"),
    ("slope_min_household_service_month", "min_household_service_month"),
    ("slope_std_household_service_month", "std_household_service_month"),
    ("slope_household_person_count", "household_person_count"),
    ("slope_data_traffic_subs_mb", "data_traffic_subs_mb"),
    ("slope_mou_ic_total", "mou_ic_total"),
    ("slope_mou_og_total", "mou_og_total"),
    ("slope_distinct_out_number", "distinct_out_number"),
]


def moving_average(base: str, lags: Sequence[int] = (1, 2)):
    """(x + x_p1 + x_p2) / 3: a missing (zero-filled) month counts as 0."""
    total = qcol(base)
    for k in lags:
        total = total + qcol(f"{base}_p{k}")
    return total / F.lit(float(len(lags) + 1))


def slope(base: str, lags: Sequence[int] = (1, 2)):
    """x / mean(x_p1, x_p2) - 1, NULL when the lag mean is 0."""
    den = None
    for k in lags:
        den = qcol(f"{base}_p{k}") if den is None else den + qcol(f"{base}_p{k}")
    return safe_ratio(qcol(base), den / F.lit(float(len(lags)))) - F.lit(1.0)


def derive_features(df: DataFrame, avg_pairs=AVG_FEATURES, slope_pairs=SLOPE_FEATURES,
                    lags: Sequence[int] = (1, 2), drop_lags: bool = True) -> DataFrame:
    """Add averages and slopes (NULL/NaN -> 0) and drop the lag columns.

    One ``select``: every derived value is a double, so its zero fill is
    applied inline instead of in a second projection.
    """
    lag_cols = {f"{b}_p{k}" for _, b in list(avg_pairs) + list(slope_pairs) for k in lags}
    keep = [c for c in df.columns if not (drop_lags and c in lag_cols)]
    derived = ([(n, moving_average(b, lags)) for n, b in avg_pairs]
               + [(n, slope(b, lags)) for n, b in slope_pairs])
    zero = F.lit(0.0)
    return df.select(*[qcol(c) for c in keep],
                     *[F.coalesce(F.nanvl(e.cast("double"), zero), zero).alias(n) for n, e in derived])
