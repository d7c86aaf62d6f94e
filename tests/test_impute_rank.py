import math
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestar.operators import impute, rank

IMPUTE_ROWS = [
    ("1", "30", None, 100.0, "Male", "Android", None, None, "NA"),
    ("2", "NA", 5.0, float("nan"), None, None, "Y", "P1", "Prospect Gold"),
    ("3", "abc", 7.0, 300.0, "Other", "Unknown", None, None, None),
    ("4", "50", float("nan"), None, "Female", "unknown", "N", None, "Weird"),
    (None, "20", 1.0, 1.0, "Male", "iOS", None, None, "Standard"),
]
SCHEMA = ("analytic_id string, age string, handset_launchprice double, credit_limit double, gender string, "
          "handset_os string, mnp_flag string, new_pack_cat string, master_segment_id string")


def test_cleanse_edges(spark):
    df = spark.createDataFrame(IMPUTE_ROWS, SCHEMA).withColumn("days_active", F.lit(None).cast("double"))
    clean, means = impute.cleanse(df, ["analytic_id"], ["days_active"])
    got = {r.analytic_id: r for r in clean.collect()}
    assert len(got) == 4 and clean.count() == 4          # NULL id dropped, nothing multiplied
    assert got["2"].age == 40.0 and got["3"].age == 40.0  # mean of 30 and 50
    assert got["1"].handset_launchprice == 6.0 and got["4"].handset_launchprice == 6.0  # NaN counts as missing
    assert got["2"].credit_limit == 200.0
    assert [got[k].gender for k in "1234"] == ["Male", "unknown", "unknown", "Female"]
    assert [got[k].handset_os for k in "1234"] == ["Android", "others", "Unknown", "others"]
    assert [got[k].mnp_flag for k in "1234"] == ["N", "Y", "N", "N"]
    assert [got[k].new_pack_cat for k in "1234"] == ["unknown", "P1", "unknown", "unknown"]
    assert [got[k].serenade for k in "1234"] == ["Classic", "Emerald", "Classic", "Weird"]
    assert all(got[k].days_active == 0.0 for k in "1234")


def test_frozen_means_are_reused(spark):
    train = spark.createDataFrame([("1", "10", 1.0, 1.0), ("2", "30", 3.0, 3.0)],
                                  "analytic_id string, age string, handset_launchprice double, credit_limit double")
    score = spark.createDataFrame([("3", None, None, None), ("4", "100", 100.0, 100.0)],
                                  "analytic_id string, age string, handset_launchprice double, credit_limit double")
    m = impute.fit_means(impute.prepare_numbers(train))
    out = {r.analytic_id: r.age for r in m.transform(impute.prepare_numbers(score)).collect()}
    assert out == {"3": 20.0, "4": 100.0}


def _check_ntile(spark, scores, buckets, parts):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(scores)], "id long, score double")
    order = [("score", True), ("id", True)]
    a = rank.add_ntiles(df, order, {"t": buckets}, num_partitions=parts)
    b = rank.window_ntiles(df, order, {"t": buckets})
    got = {r.id: r.t for r in a.collect()}
    exp = {r.id: r.t for r in b.collect()}
    assert got == exp


def test_ntile_edges(spark):
    _check_ntile(spark, [1.0, 1.0, 1.0, 2.0, 2.0, 3.0, None, 5.0, 5.0, 0.5, 7.0], 10, 4)  # ties, NULL, N%b!=0
    _check_ntile(spark, [3.0, 1.0, 2.0], 10, 8)        # N < b, empty partitions
    _check_ntile(spark, [float(i % 7) for i in range(1003)], 100, 8)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(min_value=1, max_value=300), b=st.integers(min_value=1, max_value=40),
       parts=st.integers(min_value=1, max_value=9), seed=st.integers(0, 1000))
def test_ntile_property(spark, n, b, parts, seed):
    rnd = random.Random(seed)
    _check_ntile(spark, [float(rnd.randint(0, 20)) for _ in range(n)], b, parts)


def test_ntile_plan_has_no_global_window(spark):
    df = spark.range(100).withColumn("score", F.rand(1))
    out = rank.add_ntiles(df, [("score", True), ("id", True)], {"t": 10})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ntile" not in plan.lower()
    assert math.isclose(out.agg(F.avg("t")).first()[0], 5.5)


def test_ranking_runs_its_input_once(spark):
    """An accumulator in the input counts the rows computed for a ranking."""
    from pyspark.sql import functions as F

    from lodestar.operators import rank
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    src = spark.range(2000).select("id", (F.col("id") % 7).alias("s")).mapInArrow(count, "id long, s long")
    got = rank.add_ntiles(src, [("s", True), ("id", True)], {"d": 10}).orderBy("s", "id").select("d").collect()
    assert [r.d for r in got] == [i // 200 + 1 for i in range(2000)]
    assert seen.value == 2000


def test_rows_without_a_key_are_drawn_one_by_one(spark):
    from lodestar.operators import sample
    df = spark.range(1000).selectExpr("cast(null as string) as k", "id as v", "cast(id % 2 as int) as y")
    split = sample.hash_split(df, ["k"], 0.5, 1).groupBy("split").count().collect()
    assert len(split) == 2 and all(400 < r["count"] < 600 for r in split)
    kept = sample.downsample(df, "y", {0: 0.5}, ["k"], 1).groupBy("y").count().collect()
    assert {r.y: r["count"] for r in kept}[1] == 500 and 150 < {r.y: r["count"] for r in kept}[0] < 350
