"""Star and lags in one window, the profile's month grid, and what is dealt for them."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lodestar.operators import derive, lags, pivot
from lodestar.plans import queries as Q
from lodestar.sources import standin
from lodestar.sources.standin import TestTables

STATIC = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture()
def static(spark):
    was = {k: spark.conf.get(k) for k in STATIC}
    for k, v in STATIC.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in was.items():
        spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(repr, df.collect()))


def _odd_tables(spark, folder):
    """Customers with gaps between order months, with one month only (one of
    them there twice, in two segments), orders without customer, date or
    price, and orders of a customer who isn't listed."""
    at = lambda y, m, d=10: datetime(y, m, d)
    orders, lines, key = [], [], 0
    for cust in [*range(1, 13), 77, None]:
        for j in range(1 if cust in (3, 5) else 4):
            month = (cust or 4) + j * (1 + (cust or 2) % 3)
            for _ in range(1 + (cust == 4)):
                key += 1
                day = None if cust == 6 and j == 1 else at(1996 + (month - 1) // 12, (month - 1) % 12 + 1, 28)
                price = None if cust == 7 and j == 0 else 100.25 * key
                orders.append((key, cust, "FOP"[key % 3], price, day, "1-URGENT" if key % 4 == 0 else "5-LOW"))
                for n in range(key % 4):
                    lines.append((key, None if n == 2 else (key * n) % 3, 1.0 + n, 10.5 * key, 0.01 * n, 0.02,
                                  "RAN"[(key + n) % 3], at(1996, 2 + n)))
    customers = [(c, c % 2, 10.0 * c - 20, ["BUILDING", "HOUSEHOLD", None][c % 3]) for c in range(1, 13)]
    customers += [(5, 9, 1.0, "MACHINERY")]
    for name, data, schema in (
            ("orders", orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
            ("lineitem", lines, "l_orderkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp_ntz"),
            ("customer", customers, "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string")):
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


def _grid_profile(orders, customer):
    """The profile as months of the span joined with the sums."""
    sm = standin.subscriber_months(orders)
    months = F.sequence(F.trunc("lo", "month"), F.trunc("hi", "month"), F.expr("INTERVAL 1 MONTH"))
    grid = (sm.groupBy("analytic_id").agg(F.min("ddate").alias("lo"), F.max("ddate").alias("hi"))
            .select("analytic_id", F.explode(months).alias("m"))
            .select("analytic_id", F.last_day("m").alias("ddate")).join(sm, ["analytic_id", "ddate"], "left"))
    j = grid.join(customer, grid.analytic_id == customer.c_custkey)
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return j.select("analytic_id", "ddate", F.when(F.coalesce("n_orders", F.lit(0)) >= 3, "NA")
                    .otherwise((F.col("c_nationkey") + 18).cast("string")).alias("age"),
                    F.coalesce("n_orders", F.lit(0)).cast("double").alias("days_active"),
                    F.when(F.coalesce("n_urgent", F.lit(0)) >= 2, "Suspended").otherwise("Active").alias("mobile_status"),
                    *[zero(F.col(c)).alias(n) for c, n in zip(("rev", "rev_f", "rev_o", "rev_p"), Q.PROFILE_LAG_COLS)])


def test_profile_equals_grid_joined_with_sums(spark, tmp_dir):
    t = TestTables(spark, _odd_tables(spark, tmp_dir))
    want = _grid_profile(t.raw("orders"), t.raw("customer"))
    got = t.profile()
    assert rows(got.select(*want.columns)) == rows(want)
    assert got.count() > 60 and got.filter("analytic_id = 5").count() == 2


def test_profile_is_dealt_by_subscriber_once_summed(static, tmp_dir):
    t = TestTables(static, _odd_tables(static, tmp_dir))
    text = plan(t.profile())
    # the months' sums, those by subscriber, the customers; empty months are in none of them
    assert text.count("Exchange hashpartitioning") == 3, text
    assert "Exchange" not in text[:text.index("Generate explode") if "Generate explode" in text else text.index("Generate posexplode")]


def test_pack_deals_line_items_once_after_the_join(static, tmp_dir):
    t = TestTables(static, _odd_tables(static, tmp_dir))
    text = plan(t.pack())
    assert text.count("Exchange hashpartitioning") == 3, text
    j = t.raw("lineitem").join(t.raw("orders"), F.expr("l_orderkey = o_orderkey"))
    want = j.groupBy(F.col("o_custkey").alias("analytic_id"), F.last_day("o_orderdate").alias("ddate")).agg(
        F.sum(F.round(F.col("l_quantity") * 100) + F.round(F.col("l_extendedprice") * 100)).alias("data_traffic_subs_mb"),
        F.max("l_returnflag").alias("new_pack_cat"), F.countDistinct("l_suppkey").cast("double").alias("distinct_out_number"))
    assert rows(t.pack().select(*want.columns)) == rows(want)


def _star_then_lags(t):
    """Star by joins, lags under the joined rows."""
    prof = t.profile().select("analytic_id", "ddate", *Q.PROFILE_LAG_COLS)
    hh, pack = Q.household_mart(t), t.pack()
    star = (prof.join(pack.select("analytic_id", "ddate", *Q.PACK_LAG_COLS), ["analytic_id", "ddate"], "left")
            .join(hh.select("analytic_id", "ddate", *Q.HH_COLS), ["analytic_id", "ddate"], "left")
            .select("analytic_id", "ddate", *Q.LAG_BASES))
    lagged = lags.month_lags(star, Q._histories(t, prof, hh))
    types = dict(lagged.dtypes)
    return derive.derive_features(lagged.select(*[
        F.col(c) if c in ("analytic_id", "ddate") else pivot.zero_fill(c, types[c]).alias(c) for c in lagged.columns]))


def test_avg_and_slope_equals_star_then_lags_on_odd_rows(spark, tmp_dir):
    folder = _odd_tables(spark, tmp_dir)
    got, want = Q.QUERIES["avg_and_slope"](spark, folder), _star_then_lags(TestTables(spark, folder))
    assert got.dtypes == want.dtypes
    assert rows(got) == rows(want)
    assert got.filter("analytic_id = 5").count() == 4      # listed twice: two profiles by two mart rows


def test_avg_and_slope_deals_neither_star_nor_empty_months(static, tmp_dir):
    """Nothing is dealt above the window's union, and only the mart is wide below it."""
    df = Q.QUERIES["avg_and_slope"](static, _odd_tables(static, tmp_dir))
    text = plan(df)
    exchanges = [x for x in text.splitlines() if "Exchange hashpartitioning" in x]
    assert not [x for x in exchanges if "_k0#" in x], exchanges
    top = text[:text.index("Union")]
    assert "Exchange" not in top and "Join" not in top, top
    assert text.count("ReusedExchange") >= 2, text           # members are summed once for mart rows and statistics


def test_star_in_the_lag_window_equals_joins(spark):
    day = lambda m: date(2020, m, 28)
    base = spark.createDataFrame([("a", day(1), 1.0), ("a", day(2), 2.0), ("a", day(4), 4.0), ("b", day(2), None),
                                  ("c", day(2), 3.0), ("c", day(2), 3.5), (None, day(2), 7.0), ("a", None, 8.0)],
                                 "k string, ddate date, x double")
    one = spark.createDataFrame([("a", day(1), 10), ("a", day(3), None), ("a", day(4), 40), ("b", day(2), 20), ("b", day(2), 21),
                                 ("z", day(2), 5), (None, day(2), 6), ("a", None, 9)], "k string, ddate date, y int")
    two = spark.createDataFrame([("b", day(2), "p"), ("b", day(2), "q"), ("c", day(2), None), ("a", day(2), "r")],
                                "k string, ddate date, z string")
    hist = [(base, ["x"]), (one, ["y"]), (two, ["z"])]
    got = lags.month_lags(base, hist, keys=["k"], star=True)
    assert plan(got).count("Exchange") == 1 and "Join" not in plan(got)
    star = base.join(one, ["k", "ddate"], "left").join(two, ["k", "ddate"], "left")
    copy = base.select("*")                                # a history read beside the base
    want = lags.month_lags(star, [(copy, ["x"]), *hist[1:]], keys=["k"])
    assert got.columns == want.columns == ["k", "ddate", "x", "y", "z", "x_p1", "y_p1", "z_p1", "x_p2", "y_p2", "z_p2"]
    assert rows(got) == rows(want) and got.filter("k = 'b'").count() == 4
    with pytest.raises(ValueError, match="month_bounds"):
        lags.month_lags(base, hist, keys=["k"], star=True, month_bounds=(day(2), day(2)))


def test_base_as_its_own_history_fails_on_duplicates(spark):
    from pyspark.errors import PySparkException
    base = spark.createDataFrame([("c", date(2020, 1, 31), 1), ("c", date(2020, 1, 31), 2), ("c", date(2020, 2, 29), 3)],
                                 "k string, ddate date, v int")
    with pytest.raises(PySparkException, match="history 1 has several rows of one key 1 months"):
        lags.month_lags(base, [(base, ["v"])], keys=["k"]).collect()
    assert lags.month_lags(base.filter("v < 3"), [(base.filter("v < 3"), ["v"])], keys=["k"]).count() == 2
