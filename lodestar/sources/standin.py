"""Shape the driver's test tables into the reference's table roles.

The reference reads telco tables (profile snapshots, pack usage, household
members, hourly usage, app usage, campaign contacts, owners, fraud scores,
best time to call).  The test data is a TPC-H-like star schema, so each role
is derived from it with plain DataFrame operations; every derived table
grows with the inputs.  Money and volume measures are whole cents
(``round(x * 100)``) so sums are exact in any order, which keeps the DuckDB
oracle comparison bit-stable.

Role -> source:

* contacts        orders: status F/P (+ urgent priority) -> contact status
* profile         every month of a customer's order span, order sums, customer
* pack            lineitem x orders summed per customer x month end
* household       profile months; household = nation, shape = market segment
* hourly usage    events (user_id = customer, hour of ts, value)
* app usage       events, event_type as the application
* owners          customers with a finished order in a month
* fraud           every customer at two monthly runs, deterministic decile
* call time       commonest day period of a user's events per month
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestar.functions.calendar import day_period
from lodestar.sources.tables import load

REGISTER_BASE = date(1992, 1, 1)

# Stand-in category values, picked by nation key so every recode branch is hit.
SEGMENT_CYCLE = ["NA", "Prospect Emerald", None, "Standard", "Platinum Plus",
                 "Prospect Platinum", "Prospect Gold", "Gold"]
OS_CYCLE = ["Android", "iOS", "Unknown", None, "unknown", "Symbian"]


def cents(col: str):
    return F.round(F.col(col) * 100)


def _cycle(values, key):
    arr = F.array(*[F.lit(v).cast("string") for v in values])
    return F.element_at(arr, (F.pmod(F.col(key), F.lit(len(values))) + 1).cast("int"))


def register_date(key: str = "c_custkey"):
    return F.date_add(F.lit(REGISTER_BASE), F.pmod(F.col(key), F.lit(1000)).cast("int"))


def service_month(month_col: str = "ddate"):
    return ((F.year(month_col) - 1995) * 12 + F.month(month_col)).cast("double")


def subscriber_months(orders: DataFrame) -> DataFrame:
    """Orders summed per customer x month end (one row per key)."""
    o = orders.select(
        F.col("o_custkey").alias("analytic_id"),
        F.last_day("o_orderdate").alias("ddate"),
        cents("o_totalprice").alias("amt"),
        "o_orderstatus", "o_orderpriority")
    zero = F.lit(0.0)
    return o.groupBy("analytic_id", "ddate").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum("amt").alias("rev"),
        F.sum(F.when(F.col("o_orderstatus") == "F", F.col("amt")).otherwise(zero)).alias("rev_f"),
        F.sum(F.when(F.col("o_orderstatus") == "O", F.col("amt")).otherwise(zero)).alias("rev_o"),
        F.sum(F.when(F.col("o_orderstatus") == "P", F.col("amt")).otherwise(zero)).alias("rev_p"),
        F.sum(F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0)).alias("n_urgent"),
    )


def contacts(orders: DataFrame) -> DataFrame:
    """Campaign contact log: one row per order."""
    st, urgent = F.col("o_orderstatus"), F.col("o_orderpriority") == "1-URGENT"
    status = (F.when((st == "F") & urgent, "Closure Inbound")
              .when(st == "F", "Success Closure")
              .when((st == "P") & urgent, "Success Inbound")
              .when(st == "P", "Success")
              .otherwise("No Contact"))
    return orders.select(F.col("o_custkey").alias("crm_sub_id"),
                         F.col("o_orderdate").alias("last_upd"),
                         status.alias("contact_status"))


def active_months(sub_months: DataFrame) -> DataFrame:
    """Every month end from a customer's first to last order month, with the
    sums of ``sub_months`` beside the months that have any.

    Each order month brings the empty months up to the next one with it: a
    window over the customer's order months, no join of the grid with the sums
    it comes from.  ``active_rows`` makes the rows; until then a customer's
    months are as few as their order months.
    """
    dated = sub_months.filter(F.col("analytic_id").isNotNull() & F.col("ddate").isNotNull())
    following = F.lead("ddate").over(Window.partitionBy("analytic_id").orderBy("ddate"))
    until = F.coalesce(F.add_months(F.trunc(following, "month"), -1), F.trunc("ddate", "month"))
    return dated.withColumn("_until", until)


def active_rows(order_months: DataFrame) -> DataFrame:
    """One row per month of ``active_months``; sums are 0 in the empty ones."""
    months = F.sequence(F.trunc("ddate", "month"), F.col("_until"), F.expr("INTERVAL 1 MONTH"))
    rows = order_months.select("*", F.posexplode(months).alias("_nth", "_month"))
    own = F.col("_nth") == 0
    sums = {c: F.coalesce(F.when(own, F.col(c)), F.lit(0).cast(t)).alias(c)
            for c, t in [("n_orders", "bigint"), ("rev", "double"), ("rev_f", "double"),
                         ("rev_o", "double"), ("rev_p", "double"), ("n_urgent", "bigint")]}
    return rows.select(*[F.last_day("_month").alias(c) if c == "ddate" else sums.get(c, F.col(c))
                         for c in order_months.columns if c != "_until"])


def profile(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Monthly subscriber profile snapshot keyed (analytic_id, ddate): every
    month of a customer's active span, with that month's order sums (0 when
    the customer did not order).  The customer is joined to the order months,
    before the empty ones are there; no month is dealt on its own, and the
    profile comes out dealt by subscriber."""
    spans = active_months(subscriber_months(orders))
    c = customer.select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    j = active_rows(spans.join(c, spans.analytic_id == c.c_custkey))
    return j.select(
        F.col("analytic_id"),
        F.col("c_custkey").alias("crm_sub_id"),
        F.col("c_custkey").alias("national_id"),
        register_date().alias("activation_date"),
        F.col("ddate"),
        F.when(F.col("n_orders") >= 3, F.lit("NA"))
         .otherwise((F.col("c_nationkey") + 18).cast("string")).alias("age"),
        F.when(F.col("c_acctbal") < 0, F.lit(None).cast("double"))
         .otherwise(cents("c_acctbal")).alias("credit_limit"),
        F.col("n_orders").cast("double").alias("days_active"),
        service_month().alias("service_month"),
        F.when(F.col("c_nationkey") >= 20, "Y").otherwise("N").alias("foreigner_flag"),
        F.when(F.col("c_mktsegment") == "BUILDING", "Male")
         .when(F.col("c_mktsegment") == "FURNITURE", "Female")
         .when(F.col("c_mktsegment") == "MACHINERY", F.lit(None).cast("string"))
         .otherwise("Other").alias("gender"),
        F.when(F.col("n_orders") > 1, F.lit("Y")).alias("mnp_flag"),
        _cycle(SEGMENT_CYCLE, "c_nationkey").alias("master_segment_id"),
        F.when(F.col("rev_f") == 0, F.lit(None).cast("double"))
         .otherwise(F.col("rev_f")).alias("handset_launchprice"),
        _cycle(OS_CYCLE, "c_nationkey").alias("handset_os"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", "Pre-paid")
         .otherwise("Post-paid").alias("charge_type"),
        F.when(F.col("n_urgent") >= 2, "Suspended").otherwise("Active").alias("mobile_status"),
        F.col("rev").alias("norms_net_revenue_avg_3mth_p0_p2"),
        F.col("rev_f").alias("norms_net_revenue_gprs"),
        F.col("rev_o").alias("norms_net_revenue_vas"),
        F.col("rev_p").alias("norms_net_revenue_voice"),
    )


def pack(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Monthly pack usage keyed (analytic_id, ddate) from line items.

    The line items are dealt by subscriber and month once after the join;
    counting suppliers would deal them by supplier too, and what that leaves
    (seven of ten rows) a second time.
    """
    li = lineitem.select("l_orderkey", "l_suppkey", "l_returnflag", "l_shipdate",
                         cents("l_quantity").alias("q"), cents("l_extendedprice").alias("p"),
                         (cents("l_quantity") + cents("l_extendedprice")).alias("qp"),
                         cents("l_discount").alias("d"), cents("l_tax").alias("t"))
    o = orders.select("o_orderkey", F.col("o_custkey").alias("analytic_id"),
                      F.last_day("o_orderdate").alias("ddate"))
    j = li.join(o, li.l_orderkey == o.o_orderkey).repartition("analytic_id", "ddate")
    one, zero = F.lit(1.0), F.lit(0.0)
    return j.groupBy("analytic_id", "ddate").agg(
        F.sum("q").alias("data_3g_usage_mb"),
        F.sum("p").alias("data_4g_usage_mb"),
        F.sum("qp").alias("data_traffic_subs_mb"),
        F.max("l_returnflag").alias("new_pack_cat"),
        F.count(F.lit(1)).cast("double").alias("mou_ic_total"),
        F.sum(F.when(F.col("l_returnflag") == "R", one).otherwise(zero)).alias("mou_og_intl"),
        F.sum(F.when(F.col("l_returnflag") == "A", one).otherwise(zero)).alias("mou_og_roaming"),
        F.sum("d").alias("mou_og_total"),
        F.sum(F.when(F.last_day("l_shipdate") == F.col("ddate"), one).otherwise(zero))
         .alias("num_of_days_data_used"),
        F.sum("t").alias("sms_og_total"),
        F.countDistinct("l_suppkey").cast("double").alias("distinct_out_number"),
    )


def household_members(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Household member snapshot: one row per member x month end."""
    sm = subscriber_months(orders)
    c = customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    j = sm.join(c, sm.analytic_id == c.c_custkey)
    return j.select(
        "analytic_id",
        register_date().alias("register_date"),
        F.col("c_nationkey").alias("home_analytic_id"),
        F.col("c_mktsegment").alias("geo_home_shape_id"),
        "ddate",
        F.col("rev").alias("arpu"),
        F.col("n_orders").cast("double").alias("total_voice_minute"),
        F.col("rev_f").alias("total_data_usage"),
        (F.pmod(F.col("c_custkey"), F.lit(50)) + 18).cast("double").alias("ma_age"),
        service_month().alias("service_month"),
    )


USAGE_MONTHS, USAGE_SHIFT = 12, -338      # 2024-01 -> 1995-11


def usage_day():
    """The events' day, moved into the order span: a user's events fall in one
    of ``USAGE_MONTHS`` months from 1995-11 on, picked by the user id, so the
    usage tables overlap the labelled months (all rows kept)."""
    months = F.pmod(F.col("user_id"), F.lit(USAGE_MONTHS)).cast("int") + F.lit(USAGE_SHIFT)
    return F.add_months(F.to_date("ts"), months)


def hourly_usage(events: DataFrame) -> DataFrame:
    """Hourly usage rows (subscriber x day x hour grain)."""
    amt = cents("value")
    et = F.col("event_type")
    return events.select(
        F.col("user_id").alias("analytic_id"),
        usage_day().alias("ddate"),
        usage_day().alias("date_id"),
        F.hour("ts").alias("hour_id"),
        amt.alias("data_vol_kb"),
        F.minute("ts").cast("double").alias("data_usg_minute"),
        F.when(et.isin("click", "view"), amt).otherwise(F.lit(0.0)).alias("voice_out_minute"),
        F.when(et == "purchase", amt).otherwise(F.lit(0.0)).alias("voice_in_minute"),
    )


def app_usage(events: DataFrame) -> DataFrame:
    """Application usage rows; the event type is the application."""
    return events.select(
        F.col("user_id").alias("analytic_id"),
        F.last_day(usage_day()).alias("last_date"),
        F.col("event_type").alias("application"),
        cents("value").alias("volume_ul_kb"),
        (F.hour("ts") * 100).cast("double").alias("volume_dw_kb"),
        (F.minute("ts") * 60 + F.second("ts")).cast("double").alias("duration_sec"),
        F.lit(1.0).alias("time_cnt"),
    )


def owners(orders: DataFrame) -> DataFrame:
    """Product owners per month (national_id, ddate)."""
    sm = subscriber_months(orders)
    return sm.filter(F.col("rev_f") > 0).select(F.col("analytic_id").alias("national_id"), "ddate")


FRAUD_RUNS = [date(2001, 7, 31), date(2001, 8, 31)]


def fraud_scores(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Fraud model output: every customer scored at each of two monthly runs
    (decile 1 = riskiest)."""
    runs = F.explode(F.array(*[F.lit(d) for d in FRAUD_RUNS]))
    c = customer.select("c_custkey", "c_mktsegment", runs.alias("ddate"))
    return c.select(
        F.col("c_custkey").alias("analytic_id"), register_date().alias("register_date"), "ddate",
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", "Pre-paid").otherwise("Post-paid")
         .alias("charge_type"),
        (F.pmod(F.col("c_custkey") * 7 + F.month("ddate"), F.lit(10)) + 1).cast("int")
         .alias("fraud_decile"),
    )


def call_times(events: DataFrame) -> DataFrame:
    """Best time to call: each user's commonest day period per month.

    Counting first makes each (user, month) group at most four rows, so the
    ranking window after it is small whatever the skew of the raw events.
    """
    counted = (events.select(F.col("user_id").alias("crm_sub_id"),
                             F.last_day("ts").alias("month_id"),
                             day_period(F.hour("ts")).alias("prefer_time"))
               .groupBy("crm_sub_id", "month_id", "prefer_time").agg(F.count(F.lit(1)).alias("n")))
    w = Window.partitionBy("crm_sub_id", "month_id").orderBy(F.desc("n"), F.asc("prefer_time"))
    return (counted.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1)
            .select("crm_sub_id", "month_id", "prefer_time"))


def customer_scores(customer: DataFrame) -> DataFrame:
    """A deterministic score per customer (for ranking and export checks)."""
    return customer.select(
        F.col("c_custkey").alias("crm_sub_id"),
        F.col("c_custkey").alias("analytic_id"),
        register_date().alias("register_date"),
        ((F.col("c_acctbal") + F.lit(1000.0)) / F.lit(11000.0)).alias("p1"))


class TestTables:
    """Lazy access to the driver tables and their reference-role shapes."""

    __test__ = False  # not a pytest class

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return load(self.spark, self.sf_dir, name)

    def contacts(self):
        return contacts(self.raw("orders"))

    def profile(self):
        return profile(self.raw("orders"), self.raw("customer"))

    def pack(self):
        return pack(self.raw("orders"), self.raw("lineitem"))

    def household_members(self):
        return household_members(self.raw("orders"), self.raw("customer"))

    def hourly_usage(self):
        return hourly_usage(self.raw("events"))

    def app_usage(self):
        return app_usage(self.raw("events"))

    def owners(self):
        return owners(self.raw("orders"))

    def fraud(self):
        return fraud_scores(self.raw("orders"), self.raw("customer"))  # orders unused

    def call_times(self):
        return call_times(self.raw("events"))

    def scores(self):
        return customer_scores(self.raw("customer"))
