import math
from datetime import date

import pandas as pd
from pyspark.sql import functions as F

from lodestar.operators import household


def _members(spark):
    rows = [
        ("m1", date(2020, 1, 1), "h1", "s1", 10.0, 1.0, 5.0, 30.0, 12.0),
        ("m2", date(2020, 1, 2), "h1", "s1", 20.0, 2.0, 6.0, 40.0, 24.0),
        ("m2", date(2020, 1, 2), "h1", "s1", 20.0, 2.0, 6.0, 40.0, 24.0),  # exact duplicate
        ("m3", date(2020, 1, 3), "h2", "s1", 7.0, 3.0, 1.0, 50.0, 6.0),    # one-member home
        ("m4", date(2020, 1, 4), None, "s1", 9.0, 4.0, 2.0, 20.0, 3.0),    # NULL home
    ]
    return spark.createDataFrame(rows, "analytic_id string, register_date date, home_analytic_id string, "
                                       "geo_home_shape_id string, arpu double, total_voice_minute double, "
                                       "total_data_usage double, ma_age double, service_month double")


def test_household_edges(spark):
    out = household.household_features(_members(spark))
    assert out.count() == 4                       # duplicate dropped, NULL-home member kept
    got = {r.analytic_id: r for r in out.collect()}
    assert got["m1"].household_person_count == 2 and got["m1"].total_household_arpu == 30.0
    assert math.isclose(got["m1"].std_household_arpu, math.sqrt(50.0))
    assert got["m3"].std_household_arpu is None   # sample sd of one member
    assert got["m3"].household_person_count == 1
    assert got["m4"].total_household_arpu is None  # NULL key group never joins back
    assert out.columns[:4] == ["analytic_id", "register_date", "home_analytic_id", "geo_home_shape_id"]
    assert len(out.columns) == 4 + 24


def test_household_matches_pandas(spark):
    from lodestar.sources.standin import TestTables
    t = TestTables(spark, "/root/testdata/sf0.001")
    m = t.household_members()
    out = household.household_features(m, partition_cols=["ddate"]).toPandas()
    pdf = m.toPandas().drop_duplicates()
    g = pdf.groupby(["ddate", "home_analytic_id", "geo_home_shape_id"])
    exp = pd.DataFrame({"total_household_arpu": g.arpu.sum(), "household_person_count": g.size(),
                        "std_household_age": g.ma_age.std()}).reset_index()
    merged = out.merge(exp, on=["ddate", "home_analytic_id", "geo_home_shape_id"], suffixes=("", "_x"))
    assert len(merged) == len(out) == len(pdf)
    assert (merged.total_household_arpu == merged.total_household_arpu_x).all()
    assert (merged.household_person_count == merged.household_person_count_x).all()
    both = merged.dropna(subset=["std_household_age_x"])
    assert ((both.std_household_age - both.std_household_age_x).abs() < 1e-9).all()


def test_household_month_filter_pushdown(spark):
    from lodestar.sources.standin import TestTables
    t = TestTables(spark, "/root/testdata/sf0.001")
    one = household.household_month(t.household_members(), date(1996, 1, 31))
    assert one.select(F.countDistinct("ddate")).first()[0] in (0, 1)


def test_salted_join_back_hot_household(spark):
    from lodestar.operators import skew
    rows = [(f"m{i}", "hot" if i % 3 else f"c{i}", float(i)) for i in range(3000)]
    m = spark.createDataFrame(rows, "analytic_id string, home string, arpu double")
    g = m.groupBy("home").agg(F.count(F.lit(1)).alias("n"), F.sum("arpu").alias("s"))
    salted = skew.salted_join_back(m, g, ["home"], "n", rows_per_task=100)
    plain = m.join(g, ["home"], "left")
    cols = sorted(plain.columns)
    assert salted.count() == plain.count() == 3000
    assert salted.select(cols).exceptAll(plain.select(cols)).count() == 0
    # the hot key is spread over ceil(2000 / 100) = 20 salts
    tagged = m.join(F.broadcast(g.filter("n > 100").select("home", F.ceil(F.col("n") / 100).alias("b"))),
                    "home").select(F.pmod(F.xxhash64(*[F.col(c) for c in m.columns]), F.col("b")).alias("s"))
    assert tagged.select("s").distinct().count() == 20


def test_every_hot_key_is_split(spark, monkeypatch):
    """Far more hot keys than the list's bound: the rows per task rise until the
    list is short, and no group is left out of the join."""
    from lodestar.operators import skew
    monkeypatch.setattr(skew, "MAX_HOT_KEYS", 5)
    m = spark.range(4000).select(F.col("id").alias("analytic_id"), (F.col("id") % 40).alias("home"))
    g = m.groupBy("home").agg(F.count(F.lit(1)).alias("n"))
    assert skew.hot_keys(g, ["home"], "n", 10).count() < 5
    out = skew.salted_join_back(m, g, ["home"], "n", rows_per_task=10)
    assert out.filter("n = 100").count() == 4000
    big = spark.createDataFrame([(i, 0 if i < 3000 else i) for i in range(4000)], "analytic_id long, home long")
    gb = big.groupBy("home").agg(F.count(F.lit(1)).alias("n"))
    assert [(r.home, r._buckets) for r in skew.hot_keys(gb, ["home"], "n", 10).collect()] == [(0, 4)]


def test_null_and_hot_households_are_spread_without_aqe(spark):
    """A third of the rows without a household, a third in one: the largest
    task of the join-back holds a small share of the rows, AQE off."""
    from lodestar.operators import skew
    rows = [(i, None if i % 3 == 0 else (0 if i % 3 == 1 else i)) for i in range(9000)]
    m = spark.createDataFrame(rows, "analytic_id long, home long")
    g = m.groupBy("home").agg(F.count(F.lit(1)).alias("n"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = skew.salted_join_back(m, g, ["home"], "n", rows_per_task=100)
        assert out.count() == 9000 and out.filter("home is null and n is not null").count() == 0
        per = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(per) < 0.25 * 9000


def test_household_salted_equals_plain(spark):
    from lodestar.sources.standin import TestTables
    m = TestTables(spark, "/root/testdata/sf0.001").household_members()
    a = household.household_features(m, partition_cols=["ddate"], rows_per_task=2)
    b = household.household_features(m, partition_cols=["ddate"], rows_per_task=None)
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0
