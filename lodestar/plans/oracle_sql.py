"""DuckDB SQL for the stand-in tables, composed into per-query oracle SQL.

Each CTE mirrors the DataFrame code in ``lodestar.sources.standin`` line
for line; queries list the CTEs they need and ``with_ctes`` pulls in their
dependencies in order.
"""

from __future__ import annotations

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, deps: tuple[str, ...], body: str) -> None:
    CTES[name] = (deps, body)


_cte("sub_month", (), """
    SELECT o_custkey AS analytic_id, last_day(o_orderdate) AS ddate,
           count(*) AS n_orders,
           sum(round(o_totalprice * 100)) AS rev,
           sum(CASE WHEN o_orderstatus = 'F' THEN round(o_totalprice * 100) ELSE 0::DOUBLE END) AS rev_f,
           sum(CASE WHEN o_orderstatus = 'O' THEN round(o_totalprice * 100) ELSE 0::DOUBLE END) AS rev_o,
           sum(CASE WHEN o_orderstatus = 'P' THEN round(o_totalprice * 100) ELSE 0::DOUBLE END) AS rev_p,
           sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS n_urgent
    FROM orders GROUP BY 1, 2""")

_cte("contacts", (), """
    SELECT o_custkey AS crm_sub_id, o_orderdate AS last_upd,
           CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'Closure Inbound'
                WHEN o_orderstatus = 'F' THEN 'Success Closure'
                WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'Success Inbound'
                WHEN o_orderstatus = 'P' THEN 'Success'
                ELSE 'No Contact' END AS contact_status
    FROM orders""")

_cte("active_grid", ("sub_month",), """
    SELECT g.analytic_id, g.ddate,
           coalesce(s.n_orders, 0) AS n_orders, coalesce(s.rev, 0::DOUBLE) AS rev,
           coalesce(s.rev_f, 0::DOUBLE) AS rev_f, coalesce(s.rev_o, 0::DOUBLE) AS rev_o,
           coalesce(s.rev_p, 0::DOUBLE) AS rev_p, coalesce(s.n_urgent, 0) AS n_urgent
    FROM (SELECT analytic_id, last_day(m) AS ddate FROM (
            SELECT o_custkey AS analytic_id,
                   unnest(generate_series(date_trunc('month', min(o_orderdate)),
                                          date_trunc('month', max(o_orderdate)),
                                          INTERVAL 1 MONTH)) AS m
            FROM orders GROUP BY o_custkey) x) g
    LEFT JOIN sub_month s ON s.analytic_id = g.analytic_id AND s.ddate = g.ddate""")

_cte("profile", ("active_grid",), """
    SELECT s.analytic_id, c.c_custkey AS crm_sub_id, c.c_custkey AS national_id,
           DATE '1992-01-01' + CAST(c.c_custkey % 1000 AS INTEGER) AS activation_date,
           s.ddate,
           CASE WHEN s.n_orders >= 3 THEN 'NA' ELSE CAST(c.c_nationkey + 18 AS VARCHAR) END AS age,
           CASE WHEN c.c_acctbal < 0 THEN NULL ELSE round(c.c_acctbal * 100) END AS credit_limit,
           CAST(s.n_orders AS DOUBLE) AS days_active,
           CAST((year(s.ddate) - 1995) * 12 + month(s.ddate) AS DOUBLE) AS service_month,
           CASE WHEN c.c_nationkey >= 20 THEN 'Y' ELSE 'N' END AS foreigner_flag,
           CASE WHEN c.c_mktsegment = 'BUILDING' THEN 'Male'
                WHEN c.c_mktsegment = 'FURNITURE' THEN 'Female'
                WHEN c.c_mktsegment = 'MACHINERY' THEN NULL ELSE 'Other' END AS gender,
           CASE WHEN s.n_orders > 1 THEN 'Y' END AS mnp_flag,
           (['NA', 'Prospect Emerald', NULL, 'Standard', 'Platinum Plus',
             'Prospect Platinum', 'Prospect Gold', 'Gold'])[c.c_nationkey % 8 + 1] AS master_segment_id,
           CASE WHEN s.rev_f = 0 THEN NULL ELSE s.rev_f END AS handset_launchprice,
           (['Android', 'iOS', 'Unknown', NULL, 'unknown', 'Symbian'])[c.c_nationkey % 6 + 1] AS handset_os,
           CASE WHEN c.c_mktsegment = 'HOUSEHOLD' THEN 'Pre-paid' ELSE 'Post-paid' END AS charge_type,
           CASE WHEN s.n_urgent >= 2 THEN 'Suspended' ELSE 'Active' END AS mobile_status,
           s.rev AS norms_net_revenue_avg_3mth_p0_p2, s.rev_f AS norms_net_revenue_gprs,
           s.rev_o AS norms_net_revenue_vas, s.rev_p AS norms_net_revenue_voice
    FROM active_grid s JOIN customer c ON s.analytic_id = c.c_custkey""")

_cte("pack", (), """
    SELECT o.o_custkey AS analytic_id, last_day(o.o_orderdate) AS ddate,
           sum(round(l.l_quantity * 100)) AS data_3g_usage_mb,
           sum(round(l.l_extendedprice * 100)) AS data_4g_usage_mb,
           sum(round(l.l_quantity * 100) + round(l.l_extendedprice * 100)) AS data_traffic_subs_mb,
           max(l.l_returnflag) AS new_pack_cat,
           CAST(count(*) AS DOUBLE) AS mou_ic_total,
           sum(CASE WHEN l.l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0::DOUBLE END) AS mou_og_intl,
           sum(CASE WHEN l.l_returnflag = 'A' THEN 1.0::DOUBLE ELSE 0::DOUBLE END) AS mou_og_roaming,
           sum(round(l.l_discount * 100)) AS mou_og_total,
           sum(CASE WHEN last_day(l.l_shipdate) = last_day(o.o_orderdate) THEN 1.0::DOUBLE ELSE 0::DOUBLE END)
               AS num_of_days_data_used,
           sum(round(l.l_tax * 100)) AS sms_og_total,
           CAST(count(DISTINCT l.l_suppkey) AS DOUBLE) AS distinct_out_number
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    GROUP BY 1, 2""")

_cte("hh_members", ("sub_month",), """
    SELECT s.analytic_id,
           DATE '1992-01-01' + CAST(c.c_custkey % 1000 AS INTEGER) AS register_date,
           c.c_nationkey AS home_analytic_id, c.c_mktsegment AS geo_home_shape_id, s.ddate,
           s.rev AS arpu, CAST(s.n_orders AS DOUBLE) AS total_voice_minute,
           s.rev_f AS total_data_usage, CAST(c.c_custkey % 50 + 18 AS DOUBLE) AS ma_age,
           CAST((year(s.ddate) - 1995) * 12 + month(s.ddate) AS DOUBLE) AS service_month
    FROM sub_month s JOIN customer c ON s.analytic_id = c.c_custkey""")

_USAGE_DAY = "CAST(CAST(ts AS DATE) + to_months(CAST(user_id % 12 - 338 AS INTEGER)) AS DATE)"

_cte("hourly_usage", (), f"""
    SELECT user_id AS analytic_id, {_USAGE_DAY} AS ddate, {_USAGE_DAY} AS date_id,
           hour(ts) AS hour_id, round(value * 100) AS data_vol_kb,
           CAST(minute(ts) AS DOUBLE) AS data_usg_minute,
           CASE WHEN event_type IN ('click', 'view') THEN round(value * 100) ELSE 0::DOUBLE END AS voice_out_minute,
           CASE WHEN event_type = 'purchase' THEN round(value * 100) ELSE 0::DOUBLE END AS voice_in_minute
    FROM events""")

_cte("app_usage", (), f"""
    SELECT user_id AS analytic_id, last_day({_USAGE_DAY}) AS last_date, event_type AS application,
           round(value * 100) AS volume_ul_kb, CAST(hour(ts) * 100 AS DOUBLE) AS volume_dw_kb,
           CAST(minute(ts) * 60 + second(ts) AS DOUBLE) AS duration_sec, 1.0::DOUBLE AS time_cnt
    FROM events""")

_cte("owners", ("sub_month",), """
    SELECT analytic_id AS national_id, ddate FROM sub_month WHERE rev_f > 0""")

_cte("fraud", (), """
    SELECT c.c_custkey AS analytic_id, DATE '1992-01-01' + CAST(c.c_custkey % 1000 AS INTEGER) AS register_date,
           r.ddate,
           CASE WHEN c.c_mktsegment = 'HOUSEHOLD' THEN 'Pre-paid' ELSE 'Post-paid' END AS charge_type,
           CAST((c.c_custkey * 7 + month(r.ddate)) % 10 + 1 AS INTEGER) AS fraud_decile
    FROM customer c, (SELECT unnest([DATE '2001-07-31', DATE '2001-08-31']) AS ddate) r""")

DAY_PERIOD_SQL = """CASE WHEN {h} > 0 AND {h} <= 5 THEN 'night'
                WHEN {h} > 5 AND {h} <= 12 THEN 'morning'
                WHEN {h} > 12 AND {h} <= 18 THEN 'afternoon'
                WHEN {h} > 18 AND {h} <= 24 THEN 'prime'
                WHEN {h} = 0 THEN 'prime' END"""

_cte("call_times", (), f"""
    SELECT crm_sub_id, month_id, prefer_time FROM (
        SELECT crm_sub_id, month_id, prefer_time,
               row_number() OVER (PARTITION BY crm_sub_id, month_id
                                  ORDER BY n DESC, prefer_time ASC) AS r
        FROM (SELECT user_id AS crm_sub_id, last_day(ts) AS month_id,
                     {DAY_PERIOD_SQL.format(h='hour(ts)')} AS prefer_time, count(*) AS n
              FROM events GROUP BY 1, 2, 3) t) u
    WHERE r = 1""")

_cte("scores", (), """
    SELECT c_custkey AS crm_sub_id, c_custkey AS analytic_id,
           DATE '1992-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS register_date,
           (c_acctbal + 1000.0::DOUBLE) / 11000.0::DOUBLE AS p1
    FROM customer""")


def with_ctes(names, body: str) -> str:
    """``WITH`` clause holding ``names`` and their dependencies, then ``body``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        if n not in CTES:
            raise KeyError(n)
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    parts = [f"{n} AS ({CTES[n][1]}\n)" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + body


# ----------------------------------------------------------------- fragments

WEEKDAY_SQL = ("(['01_Mon', '02_Tue', '03_Wed', '04_Thu', '05_Fri', '06_Sat', '07_Sun'])"
               "[isodow({d})]")


def q(name: str) -> str:
    """Quote an identifier for DuckDB."""
    return '"' + name.replace('"', '""') + '"'


def pivot_sql(source: str, keys: list[str], pivot_col: str, values: list[str],
              measures: list[tuple[str, str, str]]) -> str:
    """Conditional-aggregate pivot (measure-major column order), NULL -> 0."""
    cols = []
    for src, fn, suffix in measures:
        for v in values:
            cols.append(f"coalesce({fn}(CASE WHEN {pivot_col} = '{v}' THEN {src} END), 0) "
                        f"AS {q(f'{v}_{suffix}')}")
    return (f"SELECT {', '.join(keys)}, " + ",\n       ".join(cols)
            + f"\nFROM {source} GROUP BY {', '.join(keys)}")
