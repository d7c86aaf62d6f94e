"""The query set: one entry per operator group of the blueprint.

Every query reads the driver tables of ``sf_dir`` through the stand-in
adapters and runs over the whole tables.  The oracle SQL next to each query
computes the same result in DuckDB, usually in the reference's literal form
(one pivot per metric, one join per lag, a global ``ntile`` window), so the
check also proves the rewritten plans equal the literal ones.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.functions.calendar import day_period, weekday_label
from lodestar.functions.months import date_range_filter, shift_month_end, shift_month_start, yyyymm
from lodestar.operators import derive, encode, household, impute, label, lags, pivot, rank, reduce, sample, stump
from lodestar.operators import model as _model
from lodestar.plans import prepare, scoring, training
from lodestar.operators.evaluate import auc_from_roc, gains_lift, roc_table
from lodestar.plans.oracle_sql import DAY_PERIOD_SQL, WEEKDAY_SQL, pivot_sql, q, with_ctes
from lodestar.plans.registry import ORACLE, QUERIES, register, round_cols  # noqa: F401
from lodestar.session import WIDE_ROWS, session_with
from lodestar.sources import tables
from lodestar.sources.bucketed import joined_by_bucket, store_bucketed
from lodestar.sources.standin import TestTables

# Query parameters (the window and months the stand-ins are examined at).
LABEL_BEGIN, LABEL_END = date(1996, 1, 1), date(1996, 12, 31)
SCORING_MONTH = date(2001, 7, 31)
STORED_UNTIL, LAST_MONTH = date(1996, 12, 31), date(2100, 1, 31)
TREE_FITS = ("train_score", "training_pipeline", "scoring_pipeline")    # 400 trees each
TRAIN_AS_OF, SCORE_AS_OF = date(1996, 3, 15), date(1996, 6, 15)
APP_LIST = ["click", "purchase", "view", "refund"]   # a saved training list
PROFILE_LAG_COLS, PACK_LAG_COLS = training.PROFILE_LAG_COLS, training.PACK_LAG_COLS
HH_COLS = household.HOUSEHOLD_COLS
LAG_BASES = PROFILE_LAG_COLS + HH_COLS + PACK_LAG_COLS

def _work(spark, name):
    import uuid

    from lodestar.session import shared_dir
    return shared_dir(spark, f"{name}-{uuid.uuid4().hex[:12]}")


# ---------------------------------------------------------------- household

_STD = [n for n, fn, _ in household.HOUSEHOLD_STATS if fn == "stddev"]
_SQL_FN = {"sum": "sum", "avg": "avg", "max": "max", "min": "min", "stddev": "stddev_samp"}


def _hh_stats_sql() -> str:
    out = []
    for name, fn, col in household.HOUSEHOLD_STATS:
        if fn == "count":
            out.append(f"count(*) AS {name}")
        elif fn == "stddev":
            out.append(f"round(stddev_samp({col}), 2) AS {name}")
        else:
            out.append(f"{_SQL_FN[fn]}({col}) AS {name}")
    return ",\n           ".join(out)


_HH_MART_CTES = f"""
, members AS (SELECT DISTINCT * FROM hh_members)
, stats AS (
    SELECT ddate, home_analytic_id, geo_home_shape_id,
           {_hh_stats_sql()}
    FROM members GROUP BY ddate, home_analytic_id, geo_home_shape_id)
, hh_mart AS (
    SELECT m.analytic_id, m.register_date, m.home_analytic_id, m.geo_home_shape_id,
           {", ".join("s." + c for c in HH_COLS)}, m.ddate
    FROM members m LEFT JOIN stats s
      ON m.ddate = s.ddate AND m.home_analytic_id = s.home_analytic_id
     AND m.geo_home_shape_id = s.geo_home_shape_id)
"""


def household_mart(t: TestTables, dated: bool = False):
    """Household mart for every month, standard deviations rounded to cents;
    ``dated`` leaves out members without a month, who share a group with their like only."""
    members = t.household_members()
    members = members.filter(F.col("ddate").isNotNull()) if dated else members
    mart = household.household_features(members, partition_cols=["ddate"])
    return round_cols(mart, _STD, 2)


@register("household_features",
          with_ctes(["hh_members"], _HH_MART_CTES + "SELECT * FROM hh_mart"))
def q_household_features(spark, sf_dir):
    """AG1 AG5 JO4: members -> group statistics -> joined back, all months."""
    return household_mart(TestTables(spark, sf_dir))


@register("append_month", with_ctes(["hh_members"], _HH_MART_CTES + "SELECT * FROM hh_mart"))
def q_append_month(spark, sf_dir):
    """AG9 IO6: the mart written in three runs (late months, all months, the
    same again) and read back: backfilled, no month twice."""
    t = TestTables(spark, sf_dir)
    target, members = _work(spark, "mart"), t.household_members()
    scoring.update_mart(members.filter(F.col("ddate") > F.lit(STORED_UNTIL)), target, LAST_MONTH)
    scoring.update_mart(members, target, LAST_MONTH)
    scoring.update_mart(members, target, LAST_MONTH)
    back = tables.read_months(spark, target)
    return round_cols(back, _STD, 2)


@register("profile_dims", "SELECT count(*) AS n_rows, CAST(5 AS BIGINT) AS n_cols FROM customer")
def q_profile_dims(spark, sf_dir):
    """AC1 AG4: (rows, columns) of a table."""
    from lodestar.operators.profile import dims
    return dims(TestTables(spark, sf_dir).raw("customer"))


# ------------------------------------------------------------ month windows

@register("month_windows", f"""
SELECT cam_month, count(*) AS n_orders,
       CAST(date_trunc('month', cam_month) AS DATE) AS month_start,
       last_day(cam_month - INTERVAL 1 MONTH) AS p1_month,
       last_day(cam_month - INTERVAL 2 MONTH) AS prof_month,
       CAST(cam_month - INTERVAL 1 MONTH AS DATE) AS naive_p1,
       CAST(date_trunc('month', cam_month + INTERVAL 1 MONTH) AS DATE) AS next_start,
       strftime(cam_month, '%Y%m') AS yyyymm
FROM (SELECT last_day(o_orderdate) AS cam_month FROM orders
      WHERE o_orderdate >= DATE '{LABEL_BEGIN}' AND o_orderdate < DATE '1997-01-01') t
GROUP BY cam_month""")
def q_month_windows(spark, sf_dir):
    """SC1-SC5 SC7 FI1 Q1: month starts/ends, shifted month ends, yyyyMM."""
    o = TestTables(spark, sf_dir).raw("orders")
    m = (o.filter(date_range_filter("o_orderdate", LABEL_BEGIN, LABEL_END))
         .select(F.last_day("o_orderdate").alias("cam_month"))
         .groupBy("cam_month").agg(F.count(F.lit(1)).alias("n_orders")))
    return m.select(
        "cam_month", "n_orders",
        F.trunc("cam_month", "month").alias("month_start"),
        shift_month_end("cam_month", -1).alias("p1_month"),
        shift_month_end("cam_month", -2).alias("prof_month"),
        F.add_months("cam_month", -1).alias("naive_p1"),
        shift_month_start("cam_month", 1).alias("next_start"),
        yyyymm("cam_month").alias("yyyymm"))


@register("day_period_weekday", f"""
SELECT event_id, hour_id, wday, period, concat_ws('_', wday, period) AS wday_period,
       concat(concat_ws('_', wday, period), '_mean_data_vol') AS pivot_name
FROM (SELECT event_id, hour(ts) AS hour_id, {WEEKDAY_SQL.format(d='CAST(ts AS DATE)')} AS wday,
             {DAY_PERIOD_SQL.format(h='hour(ts)')} AS period
      FROM events WHERE hour(ts) BETWEEN 0 AND 23) t""")
def q_day_period_weekday(spark, sf_dir):
    """SC6 SC8 SC9 SC10 SC12 FI6: weekday labels, day periods, pivot names."""
    e = TestTables(spark, sf_dir).raw("events")
    t = (e.filter(F.hour("ts").between(0, 23))
         .select("event_id", F.hour("ts").alias("hour_id"),
                 weekday_label(F.to_date("ts")).alias("wday"),
                 day_period(F.hour("ts")).alias("period")))
    wp = F.concat_ws("_", "wday", "period")
    return t.select("event_id", "hour_id", "wday", "period", wp.alias("wday_period"),
                    F.concat(wp, F.lit("_mean_data_vol")).alias("pivot_name"))


# ----------------------------------------------------------------- reduce

@register("latest_snapshot", with_ctes(["profile"], """
SELECT * FROM profile WHERE ddate = (SELECT max(ddate) FROM profile)"""))
def q_latest_snapshot(spark, sf_dir):
    """FI8 AG10 WI5: rows of the latest month (broadcast one-row max)."""
    return reduce.latest_rows(TestTables(spark, sf_dir).profile(), "ddate")


_TARGETS_SQL = f"""
, targets AS (SELECT analytic_id, ddate FROM profile
              WHERE charge_type = 'Post-paid' AND mobile_status = 'Active'
                AND ddate BETWEEN DATE '{LABEL_BEGIN}' AND DATE '{LABEL_END}')
"""


def _targets(t: TestTables):
    p = t.profile()
    return (p.filter((F.col("charge_type") == "Post-paid") & (F.col("mobile_status") == "Active")
                     & F.col("ddate").between(F.lit(LABEL_BEGIN), F.lit(LABEL_END)))
            .select("analytic_id", "ddate"))


@register("semi_reduce_one_key", with_ctes(["profile", "hourly_usage"], _TARGETS_SQL + """
SELECT * FROM hourly_usage u
WHERE EXISTS (SELECT 1 FROM targets t WHERE t.analytic_id = u.analytic_id)"""))
def q_semi_reduce_one_key(spark, sf_dir):
    """JO8: hourly usage of the target subscribers (left semi, one key)."""
    t = TestTables(spark, sf_dir)
    return reduce.semi_reduce(t.hourly_usage(), _targets(t), ["analytic_id"])


@register("semi_reduce_two_keys", with_ctes(["profile", "pack"], _TARGETS_SQL + """
SELECT * FROM pack k
WHERE EXISTS (SELECT 1 FROM targets t WHERE t.analytic_id = k.analytic_id AND t.ddate = k.ddate)"""))
def q_semi_reduce_two_keys(spark, sf_dir):
    """JO9: pack rows of the target (subscriber, month) pairs."""
    t = TestTables(spark, sf_dir)
    return reduce.semi_reduce(t.pack(), _targets(t), ["analytic_id", "ddate"])


@register("exclude_owners", with_ctes(["profile", "owners"], f"""
SELECT * FROM profile p
WHERE ddate = DATE '{SCORING_MONTH}' AND charge_type = 'Post-paid' AND mobile_status = 'Active'
  AND NOT EXISTS (SELECT 1 FROM owners o WHERE o.national_id = p.national_id
                  AND o.ddate = (SELECT max(ddate) FROM owners))"""))
def q_exclude_owners(spark, sf_dir):
    """JO10 FI2 FI3: scoring month, minus owners of the latest owner month."""
    t = TestTables(spark, sf_dir)
    p = t.profile().filter((F.col("ddate") == F.lit(SCORING_MONTH))
                           & (F.col("charge_type") == "Post-paid")
                           & (F.col("mobile_status") == "Active"))
    own = reduce.latest_rows(t.owners(), "ddate").select("national_id")
    return reduce.anti_reduce(p, own, ["national_id"])


_RISK_BASE_SQL = """
, base AS (SELECT analytic_id, activation_date AS register_date, ddate, crm_sub_id
           FROM profile WHERE charge_type = 'Post-paid')
"""


def _risk_base(t: TestTables):
    return (t.profile().filter(F.col("charge_type") == "Post-paid")
            .select("analytic_id", F.col("activation_date").alias("register_date"),
                    "ddate", "crm_sub_id"))


@register("exclude_risk_cut0", with_ctes(["profile"], _RISK_BASE_SQL + "SELECT * FROM base"))
def q_exclude_risk_cut0(spark, sf_dir):
    """MO8 with the exclusion switched off (cut 0)."""
    t = TestTables(spark, sf_dir)
    return reduce.exclude_risk(_risk_base(t), t.fraud(), 0)


@register("exclude_risk_cut3", with_ctes(["profile", "fraud"], _RISK_BASE_SQL + """
SELECT * FROM base b WHERE NOT EXISTS (
    SELECT 1 FROM fraud f
    WHERE f.ddate = (SELECT max(ddate) FROM fraud) AND f.charge_type = 'Post-paid'
      AND f.fraud_decile <= 3
      AND f.analytic_id = b.analytic_id AND f.register_date = b.register_date)"""))
def q_exclude_risk_cut3(spark, sf_dir):
    """MO8 JO11 FI3 FI7: drop latest-month post-paid risk deciles 1-3."""
    t = TestTables(spark, sf_dir)
    return reduce.exclude_risk(_risk_base(t), t.fraud(), 3)


@register("allow_list_filter", with_ctes(["app_usage"], """
SELECT * FROM app_usage WHERE application IN
    (SELECT event_type FROM events GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 3)"""))
def q_allow_list_filter(spark, sf_dir):
    """FI5 SO2: app rows of the three commonest applications (top-k list)."""
    t = TestTables(spark, sf_dir)
    top = reduce.top_values(t.raw("events"), "event_type", 3)
    return reduce.allow_list(t.app_usage(), "application", top, "event_type")


# ------------------------------------------------------------------ labels

_RESP_IN = "('Success Closure', 'Success', 'Success Inbound', 'Closure Inbound')"
_CLOSE_IN = "('Success Closure', 'Closure Inbound')"
_TRIPLES_SQL = f"""
, triples AS (
    SELECT DISTINCT crm_sub_id,
           CASE WHEN contact_status IN {_CLOSE_IN} THEN 1 ELSE 0 END AS camp_response,
           last_day(last_upd) AS cam_month
    FROM contacts
    WHERE last_upd >= DATE '{LABEL_BEGIN}' AND last_upd < DATE '1997-01-01'
      AND contact_status IN {_RESP_IN})
"""
_RESOLVED_SQL = {
    "compat": """
, resolved AS (
    SELECT t.crm_sub_id, t.camp_response, t.cam_month FROM triples t
    LEFT JOIN (SELECT crm_sub_id, count(*) AS n FROM triples GROUP BY crm_sub_id) c
      ON t.crm_sub_id = c.crm_sub_id
    WHERE NOT (t.camp_response = 0 AND c.n > 1))
""",
    "all": """
, resolved AS (
    SELECT * FROM triples t WHERE camp_response = 1 OR NOT EXISTS
        (SELECT 1 FROM triples o WHERE o.crm_sub_id = t.crm_sub_id AND o.camp_response = 1))
""",
}
_RESOLVED_SQL["earliest"] = _RESOLVED_SQL["all"].replace("resolved AS", "resolved_all AS") + """
, resolved AS (
    SELECT crm_sub_id, camp_response, min(cam_month) AS cam_month FROM resolved_all
    GROUP BY crm_sub_id, camp_response)
"""
_ATTACH_SQL = """
SELECT r.crm_sub_id, r.camp_response, r.cam_month,
       last_day(r.cam_month - INTERVAL 2 MONTH) AS prof_month, p.analytic_id
FROM resolved r LEFT JOIN profile p
  ON p.crm_sub_id = r.crm_sub_id AND p.ddate = last_day(r.cam_month - INTERVAL 2 MONTH)"""


def _label_query(mode):
    def run(spark, sf_dir):
        t = TestTables(spark, sf_dir)
        return label.campaign_labels(t.contacts(), t.profile(), LABEL_BEGIN, LABEL_END, mode=mode)
    run.__doc__ = f"FE10 FE11 WI1 WI2 Q2-Q4: campaign labels for 1996, mode {mode!r}."
    return run


for _mode in ("earliest", "all", "compat"):
    register(f"campaign_label_{_mode}",
             with_ctes(["contacts", "profile"], _TRIPLES_SQL + _RESOLVED_SQL[_mode] + _ATTACH_SQL)
             )(_label_query(_mode))


# ------------------------------------------------------------------ pivots

_USAGE_MEASURES = pivot.USAGE_MEASURES
_TWO_STAGE_SQL = f"""
, tagged AS (
    SELECT analytic_id, CAST(date_id AS DATE) AS date,
           {WEEKDAY_SQL.format(d='CAST(date_id AS DATE)')} AS wday,
           {DAY_PERIOD_SQL.format(h='hour_id')} AS period,
           last_day(ddate) AS month_id, {", ".join(s for s, _, _ in _USAGE_MEASURES)}
    FROM hourly_usage WHERE hour_id BETWEEN 0 AND 23)
, daily AS (
    SELECT analytic_id, wday, period, month_id, date,
           {", ".join(f"sum({s}) AS {d}" for s, d, _ in _USAGE_MEASURES)}
    FROM tagged GROUP BY analytic_id, wday, period, month_id, date)
, usage_means AS (
    SELECT analytic_id, wday, period, month_id,
           {", ".join(f"avg({d}) AS {m}" for _, d, m in _USAGE_MEASURES)}
    FROM daily GROUP BY analytic_id, wday, period, month_id)
"""
_USAGE_PIVOT_SQL = _TWO_STAGE_SQL + """
, usage_long AS (SELECT *, concat_ws('_', wday, period) AS wday_period FROM usage_means)
, usage_pivot AS (
""" + pivot_sql("usage_long", ["analytic_id", "month_id"], "wday_period", pivot.WEEKDAY_PERIODS,
                [(m, "avg", m) for m in pivot.USAGE_PIVOT_ORDER]) + ")\n"
_APP_PIVOT_SQL = f"""
, apps AS (SELECT *, volume_ul_kb + volume_dw_kb AS vol_sum_kb FROM app_usage
           WHERE application IN ({", ".join(f"'{a}'" for a in APP_LIST)}))
, app_pivot AS (
""" + pivot_sql("apps", ["analytic_id", "last_date"], "application", APP_LIST,
                [(s, f, x) for s, f, x in pivot.APP_MEASURES]) + ")\n"


@register("two_stage_usage", with_ctes(["hourly_usage"], _TWO_STAGE_SQL + "SELECT * FROM usage_means"))
def q_two_stage_usage(spark, sf_dir):
    """AG6 AG7: daily sums, then means of daily sums per weekday x period."""
    t = TestTables(spark, sf_dir)
    return pivot.two_stage_mean(pivot.usage_periods(t.hourly_usage()))


@register("usage_pivot", with_ctes(["hourly_usage"], _USAGE_PIVOT_SQL + "SELECT * FROM usage_pivot"))
def q_usage_pivot(spark, sf_dir):
    """AG8 JO7 FE3: one multi-metric pivot -> 112 columns, zero-filled."""
    return pivot.usage_pivot(TestTables(spark, sf_dir).hourly_usage())


@register("app_pivot_frozen", with_ctes(["app_usage"], _APP_PIVOT_SQL + "SELECT * FROM app_pivot"))
def q_app_pivot_frozen(spark, sf_dir):
    """AG8 IO3 Q10 SC14: app pivot over a frozen list (absent apps -> 0 columns)."""
    return pivot.app_pivot(TestTables(spark, sf_dir).app_usage(), APP_LIST)


# -------------------------------------------------------------------- lags

_LAG_HIST = [("profile", "p", PROFILE_LAG_COLS), ("hh_mart", "h", HH_COLS), ("pack", "k", PACK_LAG_COLS)]


def _literal_lag_sql(base: str) -> str:
    """Reference form: one left join per history table and lag."""
    sel, joins = [], []
    for k in (1, 2):
        for table, alias, cols in _LAG_HIST:
            a = f"{alias}{k}"
            sel += [f"{a}.{c} AS {c}_p{k}" for c in cols]
            joins.append(f"LEFT JOIN {table} {a} ON {a}.analytic_id = b.analytic_id "
                         f"AND {a}.ddate = last_day(b.ddate - INTERVAL {k} MONTH)")
    return f"SELECT b.*, {', '.join(sel)}\nFROM {base} b\n" + "\n".join(joins)


def _histories(t: TestTables, prof, hh):
    return [(prof, PROFILE_LAG_COLS), (hh, HH_COLS), (t.pack(), PACK_LAG_COLS)]


@register("lag_features", with_ctes(["profile", "pack", "hh_members"], _HH_MART_CTES + f"""
, base AS (SELECT analytic_id, ddate, {", ".join(PROFILE_LAG_COLS)} FROM profile)
""" + _literal_lag_sql("base")))
def q_lag_features(spark, sf_dir):
    """JO5 JO2 PR11 SC4 Q1: months -1 and -2 of three history tables."""
    t = TestTables(spark, sf_dir)
    prof = t.profile()
    base = prof.select("analytic_id", "ddate", *PROFILE_LAG_COLS)
    return lags.month_lags(base, _histories(t, prof, household_mart(t)))


def _derive_sql() -> str:
    lag_cols = [f"{c}_p{k}" for k in (1, 2) for c in LAG_BASES]
    fill = ", ".join(f"coalesce({c}, 0) AS {c}" for c in LAG_BASES + lag_cols)
    avg = [f"({b} + {b}_p1 + {b}_p2) / 3.0::DOUBLE AS {n}" for n, b in derive.AVG_FEATURES]
    slope = [f"coalesce({b} / nullif(({b}_p1 + {b}_p2) / 2.0::DOUBLE, 0) - 1.0::DOUBLE, 0) AS {n}"
             for n, b in derive.SLOPE_FEATURES]
    return f"""
, star AS (SELECT p.analytic_id, p.ddate, {", ".join("p." + c for c in PROFILE_LAG_COLS)},
                  {", ".join("k." + c for c in PACK_LAG_COLS)}, {", ".join("h." + c for c in HH_COLS)}
           FROM profile p
           LEFT JOIN pack k ON k.analytic_id = p.analytic_id AND k.ddate = p.ddate
           LEFT JOIN hh_mart h ON h.analytic_id = p.analytic_id AND h.ddate = p.ddate)
, lagged AS ({_literal_lag_sql("star")})
, filled AS (SELECT analytic_id, ddate, {fill} FROM lagged)
SELECT analytic_id, ddate, {", ".join(LAG_BASES)},
       {", ".join(avg)},
       {", ".join(slope)}
FROM filled"""


@register("avg_and_slope", with_ctes(["profile", "pack", "hh_members"], _HH_MART_CTES + _derive_sql()))
def q_avg_and_slope(spark, sf_dir):
    """FE7 FE8 FE9 SC15 PR4 Q7 Q18: 3-month averages and slopes, lags dropped."""
    t = TestTables(session_with(spark, WIDE_ROWS), sf_dir)
    prof = t.profile().select("analytic_id", "ddate", *PROFILE_LAG_COLS)
    # the mart's members and statistics are one exchange if both leave undated members out, who meet no row;
    # dealt by subscriber as the profile already is, star and lags are one window without an exchange
    hh, pack = (h.select("analytic_id", "ddate", *cols).repartition("analytic_id")
                for h, cols in ((household_mart(t, dated=True), HH_COLS), (t.pack(), PACK_LAG_COLS)))
    lagged = lags.month_lags(prof, [(prof, PROFILE_LAG_COLS), (hh, HH_COLS), (pack, PACK_LAG_COLS)], star=True)
    types = dict(lagged.dtypes)
    filled = lagged.select(*[F.col(c) if c in ("analytic_id", "ddate")
                             else pivot.zero_fill(c, types[c]).alias(c) for c in lagged.columns])
    return derive.derive_features(filled)


_STAR_LAGS_SQL = _derive_sql()
_STAR_LAGS_SQL = _STAR_LAGS_SQL[:_STAR_LAGS_SQL.index(", filled AS")] + "SELECT * FROM lagged"
BUCKETS = 16


def bucketed_star(spark, sf_dir):
    """(star, star with lags) over profile, mart and pack stored by subscriber."""
    t, by_bucket = TestTables(spark, sf_dir), joined_by_bucket(spark)
    cols = {"profile": PROFILE_LAG_COLS, "pack": PACK_LAG_COLS, "mart": HH_COLS}
    of = {"profile": t.profile(), "pack": t.pack(), "mart": household_mart(t)}
    prof, pack, mart = (store_bucketed(of[n].select("analytic_id", "ddate", *cols[n]), n, ["analytic_id"], BUCKETS, by_bucket)
                        for n in ("profile", "pack", "mart"))
    star = (prof.join(pack, ["analytic_id", "ddate"], "left").join(mart, ["analytic_id", "ddate"], "left")
            .select("analytic_id", "ddate", *LAG_BASES))
    return star, lags.month_lags(star, [(prof, PROFILE_LAG_COLS), (mart, HH_COLS), (pack, PACK_LAG_COLS)])


@register("star_lags_bucketed", with_ctes(["profile", "pack", "hh_members"], _HH_MART_CTES + _STAR_LAGS_SQL))
def q_star_lags_bucketed(spark, sf_dir):
    """JO3 JO5 JO8 JO9: star and lags over tables stored by subscriber, without
    an exchange."""
    return bucketed_star(spark, sf_dir)[1]


@register("latest_month_stored", with_ctes(["owners"], "SELECT * FROM owners WHERE ddate = (SELECT max(ddate) FROM owners)"))
def q_latest_month_stored(spark, sf_dir):
    """FI8 AG10 WI5 IO6: months appended, the latest found by its marker."""
    owners = TestTables(spark, sf_dir).owners()
    target = _work(spark, "owners")
    tables.append_months(owners, target)
    return tables.latest_month(spark, target).select(*owners.columns)


# ------------------------------------------------------------ feature star

_STAR_BEGIN, _STAR_END = date(1995, 11, 1), date(1996, 10, 31)


_WIDE_COLS = ([f"{a}_{x}" for _, _, x in pivot.APP_MEASURES for a in APP_LIST]
              + [f"{v}_{m}" for m in pivot.USAGE_PIVOT_ORDER for v in pivot.WEEKDAY_PERIODS])
_FEAT_COLS = ([c for c in prepare.PROFILE_COLS if c not in ("analytic_id", "crm_sub_id", "ddate")]
              + [c for c in prepare.PACK_COLS if c not in ("analytic_id", "ddate")]
              + ["register_date", "home_analytic_id", "geo_home_shape_id"] + HH_COLS + _WIDE_COLS)
_STAR_TABLES = ["contacts", "profile", "pack", "hh_members", "hourly_usage", "app_usage"]


def _labels_sql(begin, end) -> str:
    """Labels of the campaign months from ``begin`` to ``end``, earliest mode."""
    triples = _TRIPLES_SQL.replace(str(LABEL_BEGIN), str(begin)).replace("1997-01-01", str(end + timedelta(days=1)))
    return triples + _RESOLVED_SQL["earliest"] + "\n, labels AS (" + _ATTACH_SQL + ")\n"


def _feat_sql(begin, end, keep: str) -> str:
    """Population (``keep`` filters profile rows ``p``) joined to all sources."""
    rng = f"ddate >= DATE '{begin}' AND ddate <= DATE '{end}'"
    return f"""
, prof AS (SELECT {", ".join(prepare.PROFILE_COLS)} FROM profile p
           WHERE charge_type = 'Post-paid' AND mobile_status = 'Active' AND {rng} AND {keep})
, pk AS (SELECT {", ".join(prepare.PACK_COLS)} FROM pack k WHERE {rng}
         AND EXISTS (SELECT 1 FROM prof f WHERE f.analytic_id = k.analytic_id AND f.ddate = k.ddate))
, hh AS (SELECT * FROM hh_mart h WHERE {rng}
         AND EXISTS (SELECT 1 FROM prof f WHERE f.analytic_id = h.analytic_id AND f.ddate = h.ddate))
, feat AS (SELECT prof.analytic_id, prof.crm_sub_id, prof.ddate, {", ".join(q(c) for c in _FEAT_COLS)}
           FROM prof LEFT JOIN pk USING (analytic_id, ddate) LEFT JOIN hh USING (analytic_id, ddate)
           LEFT JOIN (SELECT * RENAME (last_date AS ddate) FROM app_pivot) USING (analytic_id, ddate)
           LEFT JOIN (SELECT * RENAME (month_id AS ddate) FROM usage_pivot) USING (analytic_id, ddate))
"""


_LABELLED = "EXISTS (SELECT 1 FROM labels l WHERE l.crm_sub_id = p.crm_sub_id AND l.prof_month = p.ddate)"
_LABELLED_SQL = f"""
SELECT l.crm_sub_id, l.camp_response, l.cam_month, l.prof_month, l.analytic_id,
       {", ".join("f." + q(c) for c in _FEAT_COLS)}
FROM labels l LEFT JOIN feat f ON f.crm_sub_id = l.crm_sub_id AND f.ddate = l.prof_month
WHERE l.crm_sub_id IS NOT NULL"""


def _star_sql() -> str:
    return _labels_sql(LABEL_BEGIN, LABEL_END) + _feat_sql(_STAR_BEGIN, _STAR_END, _LABELLED) + _LABELLED_SQL


@register("feature_star", with_ctes(_STAR_TABLES, _HH_MART_CTES + _USAGE_PIVOT_SQL + _APP_PIVOT_SQL + _star_sql()))
def q_feature_star(spark, sf_dir):
    """JO1 JO2 JO3 JO8 JO9 PR1 PR2: labelled feature table (prep step)."""
    t = TestTables(spark, sf_dir)
    work = _work(spark, "star")       # read by several branches: written once
    labels = tables.checkpoint_table(
        label.campaign_labels(t.contacts(), t.profile(), LABEL_BEGIN, LABEL_END), f"{work}/labels")
    prof = tables.checkpoint_table(
        prepare.population(t.profile(), _STAR_BEGIN, _STAR_END, labels=labels), f"{work}/population")
    feats = prepare.feature_table(prof, t.pack(), household_mart(t), _STAR_BEGIN, _STAR_END,
                                  apps=t.app_usage(), app_values=APP_LIST, usage=t.hourly_usage())
    return prepare.label_features(labels, feats)


# ---------------------------------------------------------- impute, recode

_MEAN_SRC = """
, p AS MATERIALIZED (SELECT analytic_id, ddate, TRY_CAST(age AS DOUBLE) AS age, handset_launchprice, credit_limit
                     FROM profile WHERE analytic_id IS NOT NULL)
"""


def _mean_sql(table: str, where: str = "TRUE") -> str:
    """One row of means: sums of whole numbers (exact in any order) over counts."""
    part = lambda c: (f"CAST(sum(CAST({c} AS DECIMAL(18, 0))) AS DOUBLE) / count({c}) AS {c}")
    return f"SELECT {', '.join(part(c) for c in impute.MEAN_COLS)} FROM {table} WHERE {where}"


def _imputed_sql() -> str:
    return ", ".join(f"coalesce({c}, (SELECT m.{c} FROM m)) AS {c}" for c in impute.MEAN_COLS)


def _impute_sql(fit_where: str, apply_where: str) -> str:
    return _MEAN_SRC + f"""
, m AS MATERIALIZED ({_mean_sql("p", fit_where)})
SELECT analytic_id, ddate, {_imputed_sql()} FROM p WHERE {apply_where}"""


def _impute_src(t: TestTables):
    p = t.profile().select("analytic_id", "ddate", *impute.MEAN_COLS)
    return tables.checkpoint_table(impute.prepare_numbers(p), _work(t.spark, "impute"))     # fitted on, then filled


@register("mean_impute", with_ctes(["profile"], _impute_sql("TRUE", "TRUE")))
def q_mean_impute(spark, sf_dir):
    """FE1 AG11 SC13: text -> number, then mean imputation fitted on the table."""
    d = _impute_src(TestTables(spark, sf_dir))
    return impute.fit_means(d).transform(d)


@register("mean_impute_frozen", with_ctes(["profile"], _impute_sql(
    f"ddate >= DATE '{LABEL_BEGIN}' AND ddate <= DATE '{LABEL_END}'", f"ddate > DATE '{LABEL_END}'")))
def q_mean_impute_frozen(spark, sf_dir):
    """Q6: means fitted on the 1996 (training) months, applied to every later
    month; the stored fit is read back before it is used (IO11)."""
    from pyspark.ml.feature import ImputerModel
    d = _impute_src(TestTables(spark, sf_dir))
    path = _work(spark, "means")
    impute.fit_means(d.filter(date_range_filter("ddate", LABEL_BEGIN, LABEL_END))).write().save(path)
    return ImputerModel.load(path).transform(d.filter(F.col("ddate") > F.lit(LABEL_END)))


_FILL_ZERO = (["days_active", "service_month"] + PROFILE_LAG_COLS
              + [c for c in prepare.PACK_COLS if c not in ("analytic_id", "ddate", "new_pack_cat")])


def _recode_sql() -> str:
    zero = ", ".join(f"coalesce({c}, 0) AS {c}" for c in _FILL_ZERO)
    return f"""
, base AS (SELECT p.*, {", ".join("k." + c for c in prepare.PACK_COLS if c not in ("analytic_id", "ddate"))}
           FROM profile p LEFT JOIN pack k ON k.analytic_id = p.analytic_id AND k.ddate = p.ddate)
, b2 AS MATERIALIZED (SELECT * REPLACE (TRY_CAST(age AS DOUBLE) AS age) FROM base WHERE analytic_id IS NOT NULL)
, m AS MATERIALIZED ({_mean_sql("b2")})
SELECT analytic_id, crm_sub_id, national_id, ddate,
       {_imputed_sql()},
       coalesce(mnp_flag, 'N') AS mnp_flag,
       CASE WHEN gender IN ('Male', 'Female') THEN gender ELSE 'unknown' END AS gender,
       CASE WHEN coalesce(handset_os, 'unknown') IN ('Android', 'iOS', 'Proprietary', 'Unknown')
            THEN coalesce(handset_os, 'unknown') ELSE 'others' END AS handset_os,
       coalesce(new_pack_cat, 'unknown') AS new_pack_cat,
       {zero},
       CASE WHEN master_segment_id IS NULL OR master_segment_id IN ('NA', 'Prospect Emerald') THEN 'Classic'
            WHEN master_segment_id IN ('Platinum Plus', 'Prospect Plat Plus') THEN 'Platinum'
            WHEN master_segment_id IN ('Prospect Platinum') THEN 'Gold'
            WHEN master_segment_id IN ('Prospect Gold') THEN 'Emerald'
            WHEN master_segment_id IN ('Standard') THEN 'Classic'
            ELSE master_segment_id END AS serenade
FROM b2"""


@register("fill_and_recode", with_ctes(["profile", "pack"], _recode_sql()))
def q_fill_and_recode(spark, sf_dir):
    """FE2-FE6 FI10 PR6 JO6 Q5 Q15: one-pass cleansing; row count kept."""
    t = TestTables(spark, sf_dir)
    base = t.profile().join(t.pack(), ["analytic_id", "ddate"], "left")
    # means from the profile alone: the pack join is unique-key, rows are equal
    means = impute.fit_means(impute.prepare_numbers(t.profile().select("analytic_id", *impute.MEAN_COLS)))
    clean, _ = impute.cleanse(base, ["analytic_id", "crm_sub_id", "national_id", "ddate"], _FILL_ZERO,
                              means=means)
    return clean


# ----------------------------------------------------------------- ranking

_DECILE_SQL = """
SELECT crm_sub_id, analytic_id, register_date, p1 AS fmc_score,
       CAST(11 - ntile(10) OVER (ORDER BY p1, analytic_id) AS BIGINT) AS fmc_decile,
       CAST(101 - ntile(100) OVER (ORDER BY p1, analytic_id) AS BIGINT) AS fmc_percentile
FROM scores"""


@register("decile_percentile", with_ctes(["scores"], _DECILE_SQL))
def q_decile_percentile(spark, sf_dir):
    """WI3 WI4 SC17 Q11: exact global deciles/percentiles, distributed."""
    s = TestTables(spark, sf_dir).scores()
    r = rank.add_ntiles(s, [("p1", True), ("analytic_id", True)],
                        {"fmc_decile": 10, "fmc_percentile": 100})
    return r.select("crm_sub_id", "analytic_id", "register_date", F.col("p1").alias("fmc_score"),
                    (F.lit(11) - F.col("fmc_decile")).alias("fmc_decile"),
                    (F.lit(101) - F.col("fmc_percentile")).alias("fmc_percentile"))


_RTC_SQL = """
, rtc AS (SELECT crm_sub_id, prefer_time FROM call_times
          WHERE month_id = (SELECT max(month_id) FROM call_times))
"""


@register("best_time_to_call", with_ctes(["call_times"], _RTC_SQL + """
SELECT c.c_custkey AS crm_sub_id, coalesce(r.prefer_time, 'anytime') AS time2call
FROM customer c LEFT JOIN rtc r ON r.crm_sub_id = c.c_custkey"""))
def q_best_time_to_call(spark, sf_dir):
    """MO9 FE4 PR7 Q13: latest month's preferred call period, default anytime."""
    t = TestTables(spark, sf_dir)
    cust = t.raw("customer").select(F.col("c_custkey").alias("crm_sub_id"))
    return reduce.attach_call_time(cust, t.call_times())


@register("campaign_list", with_ctes(["scores", "call_times"], _RTC_SQL + """
SELECT s.crm_sub_id, s.analytic_id, s.register_date, s.p1 AS fmc_score,
       CAST(11 - ntile(10) OVER (ORDER BY s.p1, s.analytic_id) AS BIGINT) AS fmc_decile,
       CAST(101 - ntile(100) OVER (ORDER BY s.p1, s.analytic_id) AS BIGINT) AS fmc_percentile,
       'Post-paid' AS charge_type, 'cvm' AS model, coalesce(r.prefer_time, 'anytime') AS time2call
FROM scores s LEFT JOIN rtc r ON r.crm_sub_id = s.crm_sub_id"""))
def q_campaign_list(spark, sf_dir):
    """MO10 PR8 PR9: scores + call time -> ranked 9-column campaign list."""
    from lodestar.operators.campaign import campaign_list
    t = TestTables(spark, sf_dir)
    return campaign_list(t.scores(), call_times=t.call_times())


# -------------------------------------------------------------- evaluation

_DOC_SCORE_SQL = """
, s AS (SELECT l.doc_id, CAST(d.n_chars AS DOUBLE) / (d.n_chars + 10000.0::DOUBLE) AS score,
               l.quality FROM labels l JOIN documents d ON d.doc_id = l.doc_id)
"""


def _doc_scores(t: TestTables):
    d = t.raw("documents").select("doc_id", "n_chars")
    return (t.raw("labels").select("doc_id", "quality").join(d, "doc_id")
            .select("doc_id", (F.col("n_chars").cast("double")
                               / (F.col("n_chars") + F.lit(10000.0))).alias("score"), "quality"))


@register("roc_points", "WITH _x AS (SELECT 1)" + _DOC_SCORE_SQL + """
, b AS (SELECT score AS threshold, sum(quality) AS pos, count(*) AS cnt FROM s GROUP BY 1)
, c AS (SELECT threshold, sum(pos) OVER w AS tp, sum(cnt - pos) OVER w AS fp,
               sum(pos) OVER () AS P, sum(cnt - pos) OVER () AS N FROM b
        WINDOW w AS (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, tp / P AS tpr, fp / N AS fpr FROM c""")
def q_roc_points(spark, sf_dir):
    """MO4: ROC table (cumulative TP/FP per distinct score)."""
    return roc_table(_doc_scores(TestTables(spark, sf_dir)), "score", "quality")


@register("auc_exact", "WITH _x AS (SELECT 1)" + _DOC_SCORE_SQL + """
, r AS (SELECT quality, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS k FROM s)
, c AS (SELECT sum(quality)::DOUBLE AS p, sum(1 - quality)::DOUBLE AS n,
               sum(CASE WHEN quality = 1 THEN k ELSE 0.0::DOUBLE END) AS ranks FROM r)
SELECT (2.0::DOUBLE * ranks - p * (p + 1.0::DOUBLE)) / (2.0::DOUBLE * p * n) AS auc FROM c""")
def q_auc_exact(spark, sf_dir):
    """MO3: exact AUC of a score (the oracle counts by mean ranks)."""
    return auc_from_roc(_doc_scores(TestTables(spark, sf_dir)), "score", "quality")


@register("gains_lift", "WITH _x AS (SELECT 1)" + _DOC_SCORE_SQL + """
, r AS (SELECT *, ntile(10) OVER (ORDER BY score DESC, doc_id ASC) AS grp FROM s)
, per AS (SELECT grp, count(*) AS n, sum(quality) AS positives, min(score) AS min_score,
                 max(score) AS max_score FROM r GROUP BY grp)
, c AS (SELECT *, sum(n) OVER w AS cum_n, sum(positives) OVER w AS cum_positives,
               sum(n) OVER () AS tn, sum(positives) OVER () AS tp FROM per
        WINDOW w AS (ORDER BY grp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT CAST(grp AS BIGINT) AS "group", CAST(n AS BIGINT) AS n, CAST(positives AS BIGINT) AS positives,
       min_score, max_score, positives / n AS response_rate, (positives / n) / (tp / tn) AS lift,
       CAST(cum_n AS BIGINT) AS cum_n, CAST(cum_positives AS BIGINT) AS cum_positives,
       cum_positives / tp AS cum_capture, (cum_positives / cum_n) / (tp / tn) AS cum_lift
FROM c""")
def q_gains_lift(spark, sf_dir):
    """MO5: gains/lift table by score decile."""
    return gains_lift(_doc_scores(TestTables(spark, sf_dir)), "score", "quality", "doc_id")


# ------------------------------------------------- sampling, model, flows
# (no oracle for fitted trees; the tests check them by invariants)



def _doc_features(t: TestTables):
    """Every document with its features; ``quality`` where it is labelled."""
    d = t.raw("documents").select("doc_id", "text", "lang", "source", "n_chars")
    return (d.join(t.raw("labels").select("doc_id", "quality"), "doc_id", "left")
            .select("doc_id", "quality", F.col("n_chars").cast("double").alias("n_chars"),
                    F.size(F.split("text", r"\s+")).cast("double").alias("n_words"),
                    F.size(F.split("text", "\n")).cast("double").alias("n_lines"),
                    "lang", "source"))


def _unit_sql(purpose: str, key: str, seed: int = 567) -> str:
    text = f"concat_ws('|', '{purpose}', '{seed}', CAST({key} AS VARCHAR))"
    return f"(CAST(CAST('0x' || substr(md5({text}), 1, 8) AS UBIGINT) AS DOUBLE) / 4294967296.0::DOUBLE)"


_SAMPLED_SQL = f"(quality <> 0 OR {_unit_sql('sample', 'doc_id')} < 0.5::DOUBLE)"
_SPLIT_SQL = f"CASE WHEN {_unit_sql('split', 'doc_id')} < 0.75::DOUBLE THEN 'train' ELSE 'test' END"


@register("downsample", f"SELECT doc_id, quality, toxic FROM labels WHERE {_SAMPLED_SQL}")
def q_downsample(spark, sf_dir):
    """SA1 FI12 SE1 Q12: label 0 kept at 50% by key hash, label 1 kept whole."""
    return sample.downsample(TestTables(spark, sf_dir).raw("labels"), "quality", {0: 0.5}, ["doc_id"], seed=567)


@register("hash_split", f"SELECT doc_id, lang, source, {_SPLIT_SQL} AS split FROM documents")
def q_hash_split(spark, sf_dir):
    """SA2: 75/25 train/test tag by key hash (seed 567)."""
    d = TestTables(spark, sf_dir).raw("documents").select("doc_id", "lang", "source")
    return sample.hash_split(d, ["doc_id"], 0.75, 567)


@register("split_balance", f"""
SELECT quality, split, count(*) AS n FROM (
    SELECT quality, {_SPLIT_SQL} AS split FROM labels WHERE {_SAMPLED_SQL}) t GROUP BY quality, split""")
def q_split_balance(spark, sf_dir):
    """SA1 SA2: labels per part after down-sampling (both classes in both parts)."""
    down = sample.downsample(TestTables(spark, sf_dir).raw("labels"), "quality", {0: 0.5}, ["doc_id"], seed=567)
    return (sample.hash_split(down, ["doc_id"], 0.75, 567).groupBy("quality", "split")
            .agg(F.count(F.lit(1)).alias("n")))


@register("train_score")
def q_train_score(spark, sf_dir):
    """FE12 MO1 MO3 MO7 PR5 PR10 SC16: fit boosted trees on the labelled train
    share, score every document (p1 rounded to 4 digits)."""
    feats = tables.checkpoint_table(sample.hash_split(_doc_features(TestTables(spark, sf_dir)), ["doc_id"], 0.75, 567),
                                    _work(spark, "train-score"))
    fitted = _model.fit(feats.filter("split = 'train' and quality is not null"), "quality",
                        ["n_chars", "n_words", "n_lines"], ["lang", "source"])
    return _model.score(fitted, feats, ["doc_id", "split", "quality"])


# ------------------------------------- the closed form of one boosted split

_STUMP_NUM, _STUMP_CAT = ["n_chars", "n_e", "n_lines"], ["lang", "source", "length_class"]
_STUMP_BASE = f"""
WITH base AS (
    SELECT d.doc_id, l.quality, CAST(d.n_chars AS DOUBLE) AS n_chars,
           CAST(length(d.text) - length(replace(d.text, 'e', '')) AS DOUBLE) AS n_e,
           CAST(length(d.text) - length(replace(d.text, chr(10), '')) AS DOUBLE) AS n_lines,
           d.lang, d.source, 'c' || CAST(d.n_chars % 100 AS VARCHAR) AS length_class,
           {_SPLIT_SQL.replace("doc_id", "d.doc_id")} AS split
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
, tr AS (SELECT * FROM base WHERE split = 'train' AND quality IS NOT NULL)
"""
_STUMP_SQL = _STUMP_BASE + """
, pts AS (
    """ + " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS value, CAST(NULL AS VARCHAR) AS category, count(*) AS n, "
                             f"CAST(sum(quality) AS BIGINT) AS pos FROM tr GROUP BY {c}" for c in _STUMP_NUM) + """
    UNION ALL """ + " UNION ALL ".join(f"SELECT '{c}', sum(quality) / CAST(count(*) AS DOUBLE), {c}, count(*), CAST(sum(quality) AS BIGINT) "
                                       f"FROM tr GROUP BY {c}" for c in _STUMP_CAT) + """)
, run AS (SELECT feature, value, category, CAST(sum(n) OVER w AS BIGINT) AS nl, CAST(sum(pos) OVER w AS BIGINT) AS pl,
                 CAST(sum(n) OVER f AS BIGINT) AS na, CAST(sum(pos) OVER f AS BIGINT) AS pa FROM pts
          WINDOW w AS (PARTITION BY feature ORDER BY value, category NULLS FIRST ROWS UNBOUNDED PRECEDING),
                 f AS (PARTITION BY feature))
, cand AS (SELECT feature, value, category, nl AS n_left, pl AS pos_left, na - nl AS n_right, pa - pl AS pos_right,
                  CAST(pl * pl AS DOUBLE) / nl + CAST((pa - pl) * (pa - pl) AS DOUBLE) / (na - nl) - CAST(pa * pa AS DOUBLE) / na AS gain
           FROM run WHERE nl < na)
, per AS (SELECT * FROM cand QUALIFY row_number() OVER (PARTITION BY feature ORDER BY gain DESC, value, category NULLS FIRST) = 1)
, fit AS (SELECT *, row_number() OVER (ORDER BY gain DESC, feature) = 1 AS best FROM per)
"""


def _stump_rows(t: TestTables):
    d = t.raw("documents")
    chars = lambda c: (F.length("text") - F.length(F.replace("text", F.lit(c), F.lit("")))).cast("double")
    rows = (d.join(t.raw("labels").select("doc_id", "quality"), "doc_id", "left")
            .select("doc_id", "quality", F.col("n_chars").cast("double").alias("n_chars"), chars("e").alias("n_e"),
                    chars("\n").alias("n_lines"), "lang", "source",
                    F.concat(F.lit("c"), (F.col("n_chars") % 100).cast("string")).alias("length_class")))
    return sample.hash_split(rows, ["doc_id"], 0.75, 567)


def _stump_fit(t: TestTables, name: str):
    """(rows, counts, splits): the rows stored, predictors named by their types."""
    rows = tables.checkpoint_table(_stump_rows(t), _work(t.spark, name))
    numeric, cats = _model.predictors(rows, ["doc_id", "quality", "split"])
    train = rows.filter("split = 'train' and quality is not null")
    counts = tables.checkpoint_table(stump.class_counts(train, "quality", numeric, cats), _work(t.spark, f"{name}-counts"))
    return rows, counts, stump.best_splits(counts)


@register("tree_stump", _STUMP_SQL + """
SELECT feature, value, category, n_left, pos_left, n_right, pos_right, gain, best, CAST(best AS DOUBLE) AS importance FROM fit""")
def q_tree_stump(spark, sf_dir):
    """MO1 MO6 FE12 PR5: the exact best split of every predictor (three numbers,
    two names, a class of 100 values), the tree's split and importance."""
    return _stump_fit(TestTables(spark, sf_dir), "stump")[2]


@register("stump_scores", _STUMP_SQL + """
, top AS MATERIALIZED (SELECT *, (pos_left + pos_right) / CAST(n_left + n_right AS DOUBLE) AS p FROM fit WHERE best)
, left_cats AS (SELECT DISTINCT pts.feature, pts.category FROM pts JOIN top ON top.feature = pts.feature AND top.category IS NOT NULL
                AND (pts.value < top.value OR (pts.value = top.value AND pts.category <= top.category)))
, placed AS (SELECT b.doc_id, b.split, b.quality, t.*,
        CASE t.feature """ + " ".join(f"WHEN '{c}' THEN b.{c} <= t.value" for c in _STUMP_NUM) + " "
          + " ".join(f"WHEN '{c}' THEN EXISTS (SELECT 1 FROM left_cats x WHERE x.feature = '{c}' AND x.category = b.{c})" for c in _STUMP_CAT)
          + """ END AS goes_left
    FROM base b JOIN top t ON TRUE)
SELECT doc_id, split, quality, round(1 / (1 + exp(-(ln(p / (1 - p)) + 0.01::DOUBLE * (CASE WHEN goes_left
    THEN pos_left / CAST(n_left AS DOUBLE) - p ELSE pos_right / CAST(n_right AS DOUBLE) - p END) / (p * (1 - p))))), 4) AS p1
FROM placed""")
def q_stump_scores(spark, sf_dir):
    """MO1 MO7 IO11 PR10 SC16: the split saved, loaded, and every document scored
    beside its ids, probabilities rounded to 4 digits."""
    rows, counts, splits = _stump_fit(TestTables(spark, sf_dir), "stump-scores")
    path = _work(spark, "stump-model")
    stump.save(counts, splits, path)
    return stump.score(stump.load(spark, path), rows, _STUMP_CAT, ["doc_id", "split", "quality"])


_FOLD_SQL = "CAST(CAST(CAST('0x' || substr(md5(concat_ws('|', 'fold', '567', CAST(doc_id AS VARCHAR))), 1, 8) AS UBIGINT) % 5 AS INTEGER) AS INTEGER)"


def _encoded_sql(c: str) -> str:
    """A column's shares without a row's own fold (train), or from all folds."""
    return f"""
, {c}_n AS (SELECT {c}, fold, count(*) AS n, sum(quality) AS pos FROM tr GROUP BY ALL)
, {c}_out AS (SELECT x.{c}, o.fold, sum(CASE WHEN x.fold <> o.fold THEN n ELSE 0 END) AS n, sum(CASE WHEN x.fold <> o.fold THEN pos ELSE 0 END) AS pos
              FROM {c}_n x JOIN outs o ON TRUE GROUP BY ALL)
, {c}_te AS (SELECT {c}, {c}_out.fold, (pos + 20 * prior) / CAST(n + 20 AS DOUBLE) AS te FROM {c}_out JOIN prior ON prior.fold = {c}_out.fold)
"""


@register("target_encoding", _STUMP_BASE.replace("tr AS (SELECT *", f"tr AS (SELECT *, {_FOLD_SQL} AS fold") + f"""
, outs AS (SELECT unnest([-1, 0, 1, 2, 3, 4]) AS fold)
, prior AS (SELECT o.fold, sum(CASE WHEN t.fold <> o.fold THEN quality ELSE 0 END) / CAST(count(CASE WHEN t.fold <> o.fold THEN 1 END) AS DOUBLE) AS prior
            FROM tr t JOIN outs o ON TRUE GROUP BY o.fold)
""" + _encoded_sql("source") + _encoded_sql("length_class") + f"""
, b AS (SELECT *, CASE WHEN split = 'train' AND quality IS NOT NULL THEN {_FOLD_SQL} ELSE -1 END AS fold FROM base)
SELECT b.doc_id, b.split, round(coalesce(s.te, p.prior), 9) AS source_te, round(coalesce(c.te, p.prior), 9) AS length_class_te
FROM b JOIN prior p ON p.fold = b.fold LEFT JOIN source_te s ON s.source = b.source AND s.fold = b.fold
LEFT JOIN length_class_te c ON c.length_class = b.length_class AND c.fold = b.fold""")
def q_target_encoding(spark, sf_dir):
    """FE12: categories as cross-fitted shares of class 1, for trained rows from
    the other folds, for all others from every fold."""
    rows = tables.checkpoint_table(_stump_rows(TestTables(spark, sf_dir)), _work(spark, "target-encoding"))
    trained, cats = F.expr("split = 'train' and quality is not null"), ["source", "length_class"]
    table = tables.checkpoint_table(encode.fit(rows.filter(trained), "quality", cats, ["doc_id"]), _work(spark, "encoding"))
    out = encode.transform(table, rows, cats, ["doc_id"], trained)
    return out.select("doc_id", "split", *[F.round(f"{c}_te", 9).alias(f"{c}_te") for c in cats])


# ---------------------------------------------------------- files and logs

_SCORE_TYPES = T.StructType([
    T.StructField("crm_sub_id", T.LongType()), T.StructField("analytic_id", T.LongType()),
    T.StructField("register_date", T.DateType()), T.StructField("p1", T.DoubleType())])
_CAMPAIGN_TYPES = T.StructType([
    T.StructField("crm_sub_id", T.LongType()), T.StructField("analytic_id", T.LongType()),
    T.StructField("register_date", T.DateType()), T.StructField("fmc_score", T.DoubleType()),
    T.StructField("fmc_decile", T.LongType()), T.StructField("fmc_percentile", T.LongType()),
    T.StructField("charge_type", T.StringType()), T.StructField("model", T.StringType()),
    T.StructField("time2call", T.StringType())])


@register("score_roundtrip", with_ctes(["scores"], "SELECT * FROM scores"))
def q_score_roundtrip(spark, sf_dir):
    """IO7 IO8 IO5: scores written as delimited parts and read with a schema."""
    path = _work(spark, "scores")
    tables.write_scores(TestTables(spark, sf_dir).scores(), path)
    return tables.read_delimited(spark, path, _SCORE_TYPES)


@register("campaign_export", ORACLE["campaign_list"])
def q_campaign_export(spark, sf_dir):
    """IO9 IO10 MO10: the campaign list exported to its dated folder, read back."""
    path = tables.export_list(q_campaign_list(spark, sf_dir), _work(spark, "campaign"), SCORING_MONTH)
    return tables.read_delimited(spark, path, _CAMPAIGN_TYPES, "|")


@register("value_list", "SELECT DISTINCT event_type AS application FROM events WHERE event_type IS NOT NULL")
def q_value_list(spark, sf_dir):
    """IO2 IO3: the application list written and read back."""
    path = _work(spark, "apps")
    tables.write_value_list(TestTables(spark, sf_dir).app_usage(), "application", path)
    return tables.read_value_list(spark, path, "application")


@register("run_log", """
SELECT 'metric' AS kind, 'rows_' || t AS key, CAST(n AS VARCHAR) AS value FROM (
    SELECT 'orders' AS t, count(*) AS n FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem
    UNION ALL SELECT 'events', count(*) FROM events) x
UNION ALL SELECT 'param', 'month', '2001-07-31'""")
def q_run_log(spark, sf_dir):
    """IO12: row counts of three tables logged as metrics, read back."""
    t = TestTables(spark, sf_dir)
    path = _work(spark, "run-log")
    rows = tables.run_log_rows(params={"month": SCORING_MONTH},
                               metrics={f"rows_{n}": t.raw(n).count() for n in ("orders", "lineitem", "events")})
    tables.write_run_log(spark, rows, path)
    return spark.read.schema(tables.RUN_LOG_SCHEMA).parquet(path).select("kind", "key", "value")


def _sources(t: TestTables, work: str, through):
    """The flows' input tables (the household mart is built and stored first)."""
    scoring.update_mart(t.household_members(), f"{work}/hh_mart", through)
    house = tables.read_months(t.spark, f"{work}/hh_mart")
    return training.Sources(contacts=t.contacts(), profile=t.profile(), pack=t.pack(), house=house,
                   apps=t.app_usage(), usage=t.hourly_usage(), owners=t.owners(),
                   fraud=t.fraud(), call_times=t.call_times())


def _final_sql(base: str, month: str, ids: list[str]) -> str:
    """Lags, cleansing and derived features over the CTE ``base`` whose feature
    month is ``month``: one join per history and lag, one step per CTE."""
    lag_cols = [f"{c}_p{k}" for k in (1, 2) for c in LAG_BASES]
    sel, joins = [], []
    for k in (1, 2):
        for table, alias, cols in _LAG_HIST:
            a = f"{alias}{k}"
            sel += [f"{a}.{c} AS {c}_p{k}" for c in cols]
            joins.append(f"LEFT JOIN {table} {a} ON {a}.analytic_id = b.analytic_id "
                         f"AND {a}.ddate = last_day(b.{month} - INTERVAL {k} MONTH)")
    zero = (["days_active", "service_month"] + PROFILE_LAG_COLS + training.PACK_NUMERIC + HH_COLS + _WIDE_COLS)
    recode = _recode_sql()
    recode = recode[recode.index("       " + _imputed_sql()):recode.rindex("FROM b2")]
    for c in _FILL_ZERO:
        recode = recode.replace(f"coalesce({c}, 0) AS {c}, ", "").replace(f"coalesce({c}, 0) AS {c},", "")
    avg = [f"({b} + {b}_p1 + {b}_p2) / 3.0::DOUBLE AS {n}" for n, b in derive.AVG_FEATURES]
    slope = [f"coalesce({b} / nullif(({b}_p1 + {b}_p2) / 2.0::DOUBLE, 0) - 1.0::DOUBLE, 0) AS {n}"
             for n, b in derive.SLOPE_FEATURES]
    named = (ids + ["age", "handset_launchprice", "credit_limit", "mnp_flag", "gender", "handset_os", "new_pack_cat",
                    "serenade"] + zero)
    return f"""
, lagged AS (SELECT b.*, {", ".join(sel)} FROM {base} b {" ".join(joins)})
, c0 AS (SELECT * REPLACE (TRY_CAST(age AS DOUBLE) AS age) FROM lagged WHERE analytic_id IS NOT NULL)
, m AS MATERIALIZED ({_mean_sql("c0")})
, clean AS (SELECT {", ".join(ids)}, {", ".join(f"coalesce({q(c)}, 0) AS {q(c)}" for c in zero + lag_cols)},
{recode} FROM c0)
SELECT {", ".join(q(c) for c in named)},
       {", ".join(avg)},
       {", ".join(slope)}
FROM clean"""


def _feature_sources(t: TestTables, work: str):
    """All sources, the household mart with its deviations rounded to cents."""
    house = tables.checkpoint_table(household_mart(t), f"{work}/house")
    return training.Sources(contacts=t.contacts(), profile=t.profile(), pack=t.pack(), house=house,
                            apps=t.app_usage(), usage=t.hourly_usage(), owners=t.owners())


_TRAIN_IDS = ["analytic_id", "crm_sub_id", "camp_response", "national_id", "register_date"]


@register("training_features", with_ctes(_STAR_TABLES, _HH_MART_CTES + _USAGE_PIVOT_SQL + _APP_PIVOT_SQL
          + _labels_sql(*label.label_window(TRAIN_AS_OF))
          + _feat_sql(*prepare.feature_window(TRAIN_AS_OF, 4, True), _LABELLED)
          + ", dt AS (" + _LABELLED_SQL + ")" + _final_sql("dt", "prof_month", _TRAIN_IDS)))
def q_training_features(spark, sf_dir):
    """The training flow up to the model: labels, star, lags, cleansing, derived
    features, from all five sources."""
    work = _work(spark, "training-features")
    src = _feature_sources(TestTables(spark, sf_dir), work)
    return training.build_features(src, TRAIN_AS_OF, APP_LIST, work)[0]


@register("scoring_features", with_ctes(_STAR_TABLES + ["owners"], _HH_MART_CTES + _USAGE_PIVOT_SQL + _APP_PIVOT_SQL
          + _feat_sql(*prepare.feature_window(SCORE_AS_OF, 1, False), """NOT EXISTS (
              SELECT 1 FROM owners o WHERE o.national_id = p.national_id
              AND o.ddate = (SELECT max(ddate) FROM owners))""")
          + _final_sql("feat", "ddate", [c for c in _TRAIN_IDS if c != "camp_response"])))
def q_scoring_features(spark, sf_dir):
    """The scoring flow up to the model, means fitted on the scoring month."""
    work = _work(spark, "scoring-features")
    src = _feature_sources(TestTables(spark, sf_dir), work)
    return scoring.build_features(src, SCORE_AS_OF, APP_LIST, work)[0]


@register("training_pipeline")
def q_training_pipeline(spark, sf_dir):
    """Training flow end to end; returns the hold-out gains table."""
    from lodestar.functions.months import month_end
    t = TestTables(spark, sf_dir)
    work = _work(spark, "training")
    src = _sources(t, work, month_end(TRAIN_AS_OF, 1))
    return training.run_training(spark, src, TRAIN_AS_OF, APP_LIST, work)["gains"]


@register("scoring_pipeline")
def q_scoring_pipeline(spark, sf_dir):
    """Scoring flow end to end (after a training run); returns the campaign file."""
    from lodestar.functions.months import month_end
    t = TestTables(spark, sf_dir)
    work = _work(spark, "scoring")
    src = _sources(t, work, month_end(SCORE_AS_OF, 1))
    training.run_training(spark, src, TRAIN_AS_OF, APP_LIST, work)
    return scoring.run_scoring(src, SCORE_AS_OF, work, f"{work}/scoring")
