from datetime import date, datetime

from pyspark.sql import functions as F

from lodestar.operators import lags, pivot
from lodestar.plans import literal


def test_two_stage_mean_skips_missing_days(spark):
    # Monday 2024-01-01 and Monday 2024-01-08; the second Monday has no night row
    rows = [("u", datetime(2024, 1, 1, h), h, float(h)) for h in (0, 1, 5, 6, 12, 13, 18, 19, 23)]
    rows += [("u", datetime(2024, 1, 8, 2), 2, 10.0), ("u", datetime(2024, 1, 8, 3), 3, 20.0)]
    df = spark.createDataFrame(rows, "analytic_id string, date_id timestamp, hour_id int, data_vol_kb double")
    df = df.withColumn("ddate", F.to_date("date_id"))
    for c in ("data_usg_minute", "voice_out_minute", "voice_in_minute"):
        df = df.withColumn(c, F.lit(1.0))
    means = pivot.two_stage_mean(pivot.usage_periods(df))
    got = {(r.wday, r.period): r.mean_data_vol for r in means.collect()}
    assert got[("01_Mon", "night")] == (6.0 + 30.0) / 2     # day sums 1+5 and 10+20
    assert got[("01_Mon", "prime")] == 0.0 + 19.0 + 23.0     # one day only, not halved
    wide = pivot.usage_pivot(df).first().asDict()
    assert len(wide) == 2 + 112
    assert wide["01_Mon_night_mean_data_vol"] == 18.0 and wide["07_Sun_prime_mean_voice_in"] == 0.0


def test_merged_pivot_equals_joined_pivots(spark):
    from lodestar.sources.standin import TestTables
    u = TestTables(spark, "/root/testdata/sf0.001").hourly_usage()
    a = pivot.usage_pivot(u)
    b = literal.usage_pivot_literal(u)
    cols = sorted(a.columns)
    assert a.select(cols).exceptAll(b.select(cols)).count() == 0
    assert b.select(cols).exceptAll(a.select(cols)).count() == 0


def test_app_pivot_frozen_values(spark):
    rows = [("u", date(2024, 1, 31), "x", 1.0, 2.0, 3.0, 1.0), ("u", date(2024, 1, 31), "y", 1.0, 1.0, 1.0, 1.0)]
    apps = spark.createDataFrame(rows, "analytic_id string, last_date date, application string, "
                                       "volume_ul_kb double, volume_dw_kb double, duration_sec double, time_cnt double")
    out = pivot.app_pivot(apps, ["x", "gone"]).first().asDict()
    assert out == {"analytic_id": "u", "last_date": date(2024, 1, 31), "x_duration": 3.0, "gone_duration": 0.0,
                   "x_count": 1.0, "gone_count": 0.0, "x_vol": 3.0, "gone_vol": 0.0}


def _lags_edge(spark):
    # gap month (Feb missing), zero p1+p2, missing p2
    h = spark.createDataFrame([("a", date(2020, 1, 31), 10.0), ("a", date(2020, 3, 31), 30.0),
                               ("a", date(2020, 4, 30), 40.0), ("b", date(2020, 2, 29), 0.0),
                               ("b", date(2020, 3, 31), 0.0), ("b", date(2020, 4, 30), 5.0)],
                              "analytic_id string, ddate date, x double")
    return h


def test_month_lags_edges(spark):
    h = _lags_edge(spark)
    out = {(r.analytic_id, str(r.ddate)): (r.x_p1, r.x_p2) for r in
           lags.month_lags(h, [(h, ["x"])]).collect()}
    assert out[("a", "2020-04-30")] == (30.0, None)       # Feb is a gap
    assert out[("a", "2020-03-31")] == (None, 10.0)
    assert out[("b", "2020-04-30")] == (0.0, 0.0)
    assert out[("a", "2020-01-31")] == (None, None)


def test_month_lags_equal_literal_on_testdata(spark):
    from lodestar.plans import queries as Q
    from lodestar.sources.standin import TestTables
    t = TestTables(spark, "/root/testdata/sf0.001")
    prof = t.profile()
    base = prof.select("analytic_id", "ddate", *Q.PROFILE_LAG_COLS)
    hist = Q._histories(t, prof, Q.household_mart(t))
    a = lags.month_lags(base, hist)
    b = lags.month_lags_literal(base, hist)
    cols = sorted(a.columns)
    assert sorted(b.columns) == cols
    assert a.count() == b.count() == base.count()
    assert a.select(cols).exceptAll(b.select(cols)).count() == 0


def test_month_bounds_prune_history(spark):
    h = _lags_edge(spark)
    base = h.filter(F.col("ddate") == F.lit(date(2020, 4, 30)))
    out = lags.month_lags(base, [(h, ["x"])], month_bounds=(date(2020, 4, 30), date(2020, 4, 30)))
    got = {r.analytic_id: (r.x_p1, r.x_p2) for r in out.collect()}
    assert got == {"a": (30.0, None), "b": (0.0, 0.0)}


def test_month_lags_equal_range_window_form(spark):
    """Third formulation: a range frame over a month index (one row per key
    and month), value exactly k months back."""
    from pyspark.sql.window import Window

    from lodestar.sources.standin import TestTables
    prof = TestTables(spark, "/root/testdata/sf0.001").profile()
    cols = ["norms_net_revenue_gprs", "norms_net_revenue_vas"]
    base = prof.select("analytic_id", "ddate", *cols)
    joined = lags.month_lags(base, [(base, cols)])
    idx = base.withColumn("_i", F.year("ddate") * 12 + F.month("ddate"))
    out = idx
    for k in (1, 2):
        w = Window.partitionBy("analytic_id").orderBy("_i").rangeBetween(-k, -k)
        for c in cols:
            out = out.withColumn(f"{c}_p{k}", F.first(c).over(w))
    windowed = out.drop("_i")
    names = sorted(joined.columns)
    assert joined.select(names).exceptAll(windowed.select(names)).count() == 0
    assert windowed.select(names).exceptAll(joined.select(names)).count() == 0


def test_duplicate_history_fails_in_the_lag_window(spark):
    """Two rows of one key and month fail the query where a base row needs
    them; the plan has the exchange it had without the check."""
    import pytest
    from pyspark.errors import PySparkException
    base = spark.createDataFrame([("a", date(2020, 3, 31)), ("b", date(2020, 3, 31)), (None, date(2020, 3, 31))], "k string, ddate date")
    once = [("a", date(2020, 2, 29), 1), ("b", date(2020, 1, 31), 2), (None, date(2020, 2, 29), 5), (None, date(2020, 2, 29), 6)]
    hist = lambda rows: spark.createDataFrame(rows, "k string, ddate date, v int")
    good = lags.month_lags(base, [(hist(once), ["v"])], keys=["k"])
    assert {(r.k, r.v_p1, r.v_p2) for r in good.collect()} == {("a", 1, None), ("b", None, 2), (None, None, None)}
    twice = lags.month_lags(base, [(hist(once + [("a", date(2020, 2, 29), 9)]), ["v"])], keys=["k"])
    with pytest.raises(PySparkException, match="several rows of one key 1 months"):
        twice.collect()
    far = hist(once + [("a", date(2019, 2, 28), 9), ("a", date(2019, 2, 28), 8)])          # no row looks there
    assert lags.month_lags(base, [(far, ["v"])], keys=["k"]).count() == 3
    plans = [lags.month_lags(base, [(hist(once), ["v"])], keys=["k"], check=c)._jdf.queryExecution().executedPlan().toString() for c in (True, False)]
    assert plans[0].count("Exchange") == plans[1].count("Exchange") == 1
