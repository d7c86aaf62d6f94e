"""Campaign labels: contacts -> one response per subscriber and month.

The raw contact log may repeat a subscriber many times (one key can hold a
large share of rows).  The first step is a ``distinct`` on
(subscriber, response, month), which Spark pre-aggregates map-side; after
it each subscriber has at most 2 x (months in the window) rows, so the
per-subscriber window that follows works on small, bounded groups.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestar.functions.months import date_range_filter, month_end, month_start, shift_month_end

# Fixed values (must equal the reference's contact statuses): statuses that
# count as a response, and the subset that counts as a closure (label 1).
RESPONSE_STATUSES = ["Success Closure", "Success", "Success Inbound", "Closure Inbound"]
CLOSURE_STATUSES = ["Success Closure", "Closure Inbound"]

MODES = ("earliest", "all", "compat")


def label_window(as_of, month_lag: int = 1) -> tuple[date, date]:
    """(first day, last day) of the two campaign months before ``as_of``."""
    return month_start(as_of, month_lag + 1), month_end(as_of, month_lag)


def campaign_responses(contacts: DataFrame, begin, end, id_col: str = "crm_sub_id",
                       ts_col: str = "last_upd", status_col: str = "contact_status",
                       closed_end: bool = False) -> DataFrame:
    """Distinct (crm_sub_id, camp_response, cam_month) in the window.

    ``closed_end=False`` keeps contacts at any time of the last day;
    ``closed_end=True`` compares with the end date itself, as a plain
    date bound on a timestamp does.
    """
    status = F.col(status_col)
    return (contacts
            .filter(date_range_filter(ts_col, begin, end, closed_end))
            .filter(status.isin(RESPONSE_STATUSES))
            .select(F.col(id_col).alias("crm_sub_id"),
                    F.when(status.isin(CLOSURE_STATUSES), 1).otherwise(0).cast("int")
                     .alias("camp_response"),
                    F.last_day(ts_col).alias("cam_month"))
            .distinct())


def resolve_responses(triples: DataFrame, mode: str = "earliest") -> DataFrame:
    """Keep one outcome per subscriber.

    * ``"all"``: a subscriber with any closure keeps only closures; others
      keep their non-closure months.
    * ``"earliest"``: as ``"all"``, then only the first month per
      (subscriber, response).
    * ``"compat"``: drops every non-closure row of a subscriber with more
      than one (response, month) row, whether or not a closure exists, and
      keeps all months.
    Rows with a NULL id keep closures only, in every mode.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    by_sub = Window.partitionBy("crm_sub_id")
    resp = F.col("camp_response")
    if mode == "compat":
        n = F.when(F.col("crm_sub_id").isNotNull(), F.count(F.lit(1)).over(by_sub))
        out = triples.withColumn("_n", n).filter(~((resp == 0) & (F.col("_n") > 1)))
        return out.drop("_n")
    has_closure = F.when(F.col("crm_sub_id").isNotNull(), F.max(resp).over(by_sub))
    kept = triples.withColumn("_c", has_closure).filter((resp == 1) | (F.col("_c") == 0))
    kept = kept.drop("_c")
    if mode == "all":
        return kept
    return kept.groupBy("crm_sub_id", "camp_response").agg(F.min("cam_month").alias("cam_month"))


def attach_profile(labels: DataFrame, profile: DataFrame, months_back: int = 2,
                   id_col: str = "crm_sub_id", profile_month: str = "ddate",
                   profile_cols=("analytic_id",), month_bounds=None) -> DataFrame:
    """Add ``prof_month`` (month end ``months_back`` before the campaign
    month) and the profile columns of that month (left join, so no label row
    is lost).  ``month_bounds`` = (first, last) profile month end, a literal
    range filter that reaches the profile scan."""
    lab = labels.withColumn("prof_month", shift_month_end("cam_month", -months_back))
    prof = profile.select(F.col(id_col), F.col(profile_month).alias("prof_month"),
                          *profile_cols)
    if month_bounds is not None:
        lo, hi = month_bounds
        prof = prof.filter(F.col("prof_month").between(F.lit(lo), F.lit(hi)))
    return lab.join(prof, [id_col, "prof_month"], "left").select(
        id_col, "camp_response", "cam_month", "prof_month", *profile_cols)


def campaign_labels(contacts: DataFrame, profile: DataFrame, begin, end,
                    mode: str = "earliest", months_back: int = 2,
                    closed_end: bool = False, **kw) -> DataFrame:
    """Contacts -> labelled subscribers with their profile month and id."""
    triples = campaign_responses(contacts, begin, end, closed_end=closed_end, **kw)
    resolved = resolve_responses(triples, mode)
    bounds = (month_end(begin, months_back), month_end(end, months_back))
    return attach_profile(resolved, profile, months_back=months_back, month_bounds=bounds)
