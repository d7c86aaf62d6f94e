from datetime import date, datetime

from lodestar.operators import label

ROWS = [
    # closure + success in the same month
    ("a", datetime(2020, 1, 5), "Success Closure"), ("a", datetime(2020, 1, 9), "Success"),
    # success in two months
    ("b", datetime(2020, 1, 5), "Success"), ("b", datetime(2020, 2, 5), "Success Inbound"),
    # closure in two months
    ("c", datetime(2020, 1, 5), "Closure Inbound"), ("c", datetime(2020, 2, 5), "Success Closure"),
    # one success only, duplicated
    ("d", datetime(2020, 2, 3), "Success"), ("d", datetime(2020, 2, 3), "Success"),
    # NULL id and "NA" id
    (None, datetime(2020, 1, 5), "Success"), (None, datetime(2020, 1, 6), "Success Closure"),
    ("NA", datetime(2020, 1, 5), "Success"),
    # 10:00 on the last day; and a non-response status
    ("e", datetime(2020, 2, 29, 10, 0), "Success"), ("f", datetime(2020, 2, 10), "No Answer"),
]


def _contacts(spark):
    return spark.createDataFrame(ROWS, "crm_sub_id string, last_upd timestamp, contact_status string")


def _set(df):
    return {(r.crm_sub_id, r.camp_response, str(r.cam_month)) for r in df.collect()}


def test_label_window():
    assert label.label_window(date(2020, 4, 15), 1) == (date(2020, 2, 1), date(2020, 3, 31))


def test_triples_and_bounds(spark):
    c = _contacts(spark)
    half = label.campaign_responses(c, date(2020, 1, 1), date(2020, 2, 29))
    closed = label.campaign_responses(c, date(2020, 1, 1), date(2020, 2, 29), closed_end=True)
    assert ("e", 0, "2020-02-29") in _set(half)
    assert ("e", 0, "2020-02-29") not in _set(closed)
    assert not any(r[0] == "f" for r in _set(half))
    assert half.count() == 11


def test_modes(spark):
    t = label.campaign_responses(_contacts(spark), date(2020, 1, 1), date(2020, 2, 29))
    all_ = _set(label.resolve_responses(t, "all"))
    earliest = _set(label.resolve_responses(t, "earliest"))
    compat = _set(label.resolve_responses(t, "compat"))
    assert ("a", 0, "2020-01-31") not in all_ and ("a", 1, "2020-01-31") in all_
    assert {("b", 0, "2020-01-31"), ("b", 0, "2020-02-29")} <= all_
    assert ("b", 0, "2020-02-29") not in earliest and ("c", 1, "2020-02-29") not in earliest
    assert ("c", 1, "2020-01-31") in earliest
    # compat: b has n=2 so both zero rows go; a's zero goes; NULL id keeps its closure only
    assert not any(r[0] == "b" for r in compat)
    assert (None, 1, "2020-01-31") in compat and (None, 0, "2020-01-31") not in compat
    assert ("d", 0, "2020-02-29") in compat and ("NA", 0, "2020-01-31") in compat


def test_attach_profile_left_join(spark):
    t = label.campaign_responses(_contacts(spark), date(2020, 1, 1), date(2020, 2, 29))
    lab = label.resolve_responses(t, "earliest")
    prof = spark.createDataFrame([("a", "A1", date(2019, 11, 30)), ("c", "C1", date(2019, 11, 30))],
                                 "crm_sub_id string, analytic_id string, ddate date")
    out = label.attach_profile(lab, prof)
    assert out.count() == lab.count()
    got = {(r.crm_sub_id, r.camp_response): (str(r.prof_month), r.analytic_id) for r in out.collect()}
    assert got[("a", 1)] == ("2019-11-30", "A1")
    assert got[("b", 0)][1] is None


def test_hot_subscriber_is_bounded_before_the_window(spark):
    from pyspark.sql import functions as F
    n = 30000
    base = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id").cast("string")))
         .alias("crm_sub_id"),
        (F.lit(datetime(2020, 1, 1)) + F.make_interval(days=(F.col("id") % 59).cast("int"))).alias("last_upd"),
        F.when(F.col("id") % 7 == 0, "Success Closure").otherwise("Success").alias("contact_status"))
    triples = label.campaign_responses(base, date(2020, 1, 1), date(2020, 2, 29))
    hot = triples.filter("crm_sub_id = 'hot'").count()
    assert hot <= 2 * 2                       # at most (2 responses) x (2 months) rows reach the window
    out = {(r.crm_sub_id, r.camp_response, str(r.cam_month))
           for r in label.resolve_responses(triples, "earliest").collect()}
    assert {(k, v) for k, v, _ in out if k == "hot"} == {("hot", 1)}
    assert ("hot", 1, "2020-01-31") in out
