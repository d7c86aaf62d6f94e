from datetime import date, datetime

from pyspark.sql import functions as F

from lodestar.functions import calendar, months, values


def test_driver_month_helpers():
    assert months.month_end(date(2020, 3, 15), 1) == date(2020, 2, 29)
    assert months.month_end(date(2019, 3, 31), 1) == date(2019, 2, 28)
    assert months.month_start(date(2020, 3, 31), 2) == date(2020, 1, 1)
    assert months.add_months_date(date(2020, 3, 31), -1) == date(2020, 2, 29)
    assert months.month_end(date(2020, 1, 1), 0) == date(2020, 1, 31)


def test_shift_month_end_vs_naive_add_months(spark):
    df = spark.createDataFrame([(date(2020, 2, 29),), (date(2020, 4, 30),), (date(2020, 3, 31),),
                                (date(2019, 2, 28),), (date(2020, 5, 1),)], "d date")
    rows = df.select("d", months.shift_month_end("d", -1).alias("p1"),
                     months.shift_month_end("d", -2).alias("p2"),
                     F.add_months("d", -1).alias("naive")).collect()
    got = {r.d: (r.p1, r.p2, r.naive) for r in rows}
    assert got[date(2020, 4, 30)] == (date(2020, 3, 31), date(2020, 2, 29), date(2020, 3, 30))
    assert got[date(2020, 2, 29)][:2] == (date(2020, 1, 31), date(2019, 12, 31))
    assert got[date(2020, 3, 31)][:2] == (date(2020, 2, 29), date(2020, 1, 31))
    assert got[date(2020, 5, 1)][:2] == (date(2020, 4, 30), date(2020, 3, 31))


def test_weekday_and_period(spark):
    # 2024-01-01 is a Monday
    df = spark.createDataFrame([(date(2024, 1, d), h) for d, h in
                                [(1, 0), (2, 1), (3, 5), (4, 6), (5, 12), (6, 13), (7, 18), (7, 19), (7, 23)]],
                               "d date, h int")
    rows = df.select(calendar.weekday_label("d").alias("w"), calendar.day_period("h").alias("p")).collect()
    assert [r.w for r in rows] == ["01_Mon", "02_Tue", "03_Wed", "04_Thu", "05_Fri", "06_Sat",
                                   "07_Sun", "07_Sun", "07_Sun"]
    assert [r.p for r in rows] == ["prime", "night", "night", "morning", "morning", "afternoon",
                                   "afternoon", "prime", "prime"]
    assert df.select(calendar.day_period(F.lit(25)).alias("p")).first().p is None


def test_date_range_half_open_vs_closed(spark):
    df = spark.createDataFrame([(datetime(2020, 2, 29, 10, 0),), (datetime(2020, 2, 29, 0, 0),),
                                (datetime(2020, 3, 1, 0, 0),)], "t timestamp")
    half = df.filter(months.date_range_filter("t", date(2020, 2, 1), date(2020, 2, 29))).count()
    closed = df.filter(months.date_range_filter("t", date(2020, 2, 1), date(2020, 2, 29),
                                                closed_end=True)).count()
    assert (half, closed) == (2, 1)


def test_values(spark):
    df = spark.createDataFrame([("NA", "x", "12", 0.0), (None, None, "abc", 2.0),
                                ("Standard", "Male", None, 4.0)], "s string, g string, a string, d double")
    rows = df.select(values.loyalty_class("s").alias("c"), values.keep_or("g", ["Male"], "unknown").alias("k"),
                     values.to_number("a").alias("n"), values.safe_ratio(F.lit(1.0), "d").alias("r"),
                     values.present_id("s").alias("p")).collect()
    assert [r.c for r in rows] == ["Classic", "Classic", "Classic"]
    assert [r.k for r in rows] == ["unknown", "unknown", "Male"]
    assert [r.n for r in rows] == [12.0, None, None]
    assert [r.r for r in rows] == [None, 0.5, 0.25]
    assert [r.p for r in rows] == [False, False, True]
    m = spark.createDataFrame([(v,) for v in ["Platinum Plus", "Prospect Plat Plus", "Prospect Platinum",
                                              "Prospect Gold", "Prospect Emerald", "Gold"]], "s string")
    assert [r.c for r in m.select(values.loyalty_class("s").alias("c")).collect()] == [
        "Platinum", "Platinum", "Gold", "Emerald", "Classic", "Gold"]


def test_cluster_settings_scale():
    from lodestar.session import cluster_settings
    big = cluster_settings(100 * 1024 ** 4, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 524288   # 100 TiB / 200 MiB
    small = cluster_settings(10 * 1024 ** 2, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16


def test_driver_month_helpers_match_spark(spark):
    import random

    from pyspark.sql import functions as F
    rnd = random.Random(7)
    days = [date(1996, 1, 1).toordinal() + rnd.randint(0, 365 * 12) for _ in range(300)]
    ds = [date.fromordinal(d) for d in days] + [date(2000, 2, 29), date(2100, 2, 28), date(2020, 3, 31)]
    ks = [rnd.randint(-14, 14) for _ in ds]
    df = spark.createDataFrame(list(zip(ds, ks)), "d date, k int")
    rows = df.select("d", "k", F.last_day(F.expr("add_months(d, k)")).alias("e"),
                     F.trunc(F.expr("add_months(d, k)"), "month").alias("s")).collect()
    for r in rows:
        assert months.month_end(r.d, -r.k) == r.e
        assert months.month_start(r.d, -r.k) == r.s
