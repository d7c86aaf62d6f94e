"""Feature preparation: reduce the sources to the population, pivot, join.

All monthly sources are keyed (analytic_id, month end), so the star of left
joins shuffles each source once on that key and the joined side is never
re-shuffled.  Source filters are literal month ranges (pushed to the scans);
the population filter is a semi join on the key set.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.months import date_range_filter, month_end, month_start
from lodestar.functions.values import present_id
from lodestar.operators import pivot, reduce

# Fixed values (must equal the reference's selections): profile and pack
# columns kept for the feature table, in the reference's order.
PROFILE_COLS = ["analytic_id", "national_id", "crm_sub_id", "activation_date", "ddate",
                "age", "credit_limit", "days_active", "service_month", "foreigner_flag", "gender",
                "mnp_flag", "master_segment_id",
                "handset_launchprice", "handset_os",
                "norms_net_revenue_avg_3mth_p0_p2", "norms_net_revenue_gprs",
                "norms_net_revenue_vas", "norms_net_revenue_voice"]
PACK_COLS = ["analytic_id", "ddate", "data_3g_usage_mb", "data_4g_usage_mb",
             "data_traffic_subs_mb", "new_pack_cat",
             "mou_ic_total", "mou_og_intl", "mou_og_roaming", "mou_og_total",
             "num_of_days_data_used", "sms_og_total", "distinct_out_number"]
KEY = ["analytic_id", "ddate"]


def feature_window(as_of, lag_time: int, training: bool):
    """(first day, last month end) of the feature months."""
    begin = month_start(as_of, lag_time)
    end = month_end(as_of, lag_time - 1 if training else lag_time)
    return begin, end


def population(profile: DataFrame, begin, end, labels: DataFrame | None = None,
               owners: DataFrame | None = None, charge: str = "Post-paid",
               status: str = "Active") -> DataFrame:
    """Active subscribers of the charge type in the window.

    Training: restricted to the labelled (subscriber, profile month) pairs.
    Scoring: minus the owners of the latest owner month.
    """
    p = profile.filter((F.col("charge_type") == charge) & (F.col("mobile_status") == status)
                       & date_range_filter("ddate", begin, end))
    if labels is not None:
        p = reduce.semi_reduce(p, labels, ["crm_sub_id", ("ddate", "prof_month")])
    if owners is not None:
        latest = reduce.latest_rows(owners, "ddate").select("national_id")
        p = reduce.anti_reduce(p, latest, ["national_id"])
    return p


def feature_table(prof: DataFrame, pack: DataFrame, house: DataFrame, begin, end,
                  apps: DataFrame | None = None, app_values: Sequence[str] | None = None,
                  usage: DataFrame | None = None) -> DataFrame:
    """profile + pack + household (+ app and usage pivots) at subscriber x month."""
    ids = prof.select(*KEY)
    pk = reduce.semi_reduce(pack.filter(date_range_filter("ddate", begin, end)), ids, KEY)
    hh = reduce.semi_reduce(house.filter(date_range_filter("ddate", begin, end)), ids, KEY)
    out = (prof.select(*PROFILE_COLS)
           .join(pk.select(*PACK_COLS), KEY, "left")
           .join(hh, KEY, "left"))
    subs = prof.select("analytic_id")
    if apps is not None:
        a = reduce.semi_reduce(apps.filter(date_range_filter("last_date", begin, end)), subs, ["analytic_id"])
        wide = pivot.app_pivot(a, app_values).withColumnRenamed("last_date", "ddate")
        out = out.join(wide, KEY, "left")
    if usage is not None:
        u = reduce.semi_reduce(usage.filter(date_range_filter("ddate", begin, end)), subs, ["analytic_id"])
        wide = pivot.usage_pivot(u).withColumnRenamed("month_id", "ddate")
        out = out.join(wide, KEY, "left")
    return out


def label_features(labels: DataFrame, features: DataFrame) -> DataFrame:
    """Labels (ids present) with the features of their profile month."""
    f = features.drop("analytic_id").withColumnRenamed("ddate", "prof_month")
    return labels.filter(present_id("crm_sub_id")).join(f, ["crm_sub_id", "prof_month"], "left")
