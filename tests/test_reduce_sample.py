import hashlib
from datetime import date

from pyspark.sql import functions as F

from lodestar.operators import reduce, sample


def test_anti_join_null_keys(spark):
    left = spark.createDataFrame([("a",), (None,), ("b",)], "key string")
    right = spark.createDataFrame([("a",), (None,)], "key string")
    assert sorted(r.key or "<null>" for r in reduce.anti_reduce(left, right, ["key"]).collect()) == ["<null>", "b"]
    assert [r.key for r in reduce.semi_reduce(left, right, ["key"]).collect()] == ["a"]


def test_semi_join_repeated_keys(spark):
    facts = spark.range(1000).withColumn("k", F.col("id") % 10)
    keys = spark.createDataFrame([(1,), (2,), (2,)], "k long")
    assert reduce.semi_reduce(facts, keys, ["k"]).count() == 200


def test_semi_join_different_names(spark):
    left = spark.createDataFrame([("a", date(2020, 1, 31)), ("a", date(2020, 2, 29))], "crm_sub_id string, ddate date")
    keys = spark.createDataFrame([("a", date(2020, 2, 29))], "crm_sub_id string, prof_month date")
    out = reduce.semi_reduce(left, keys, ["crm_sub_id", ("ddate", "prof_month")]).collect()
    assert [str(r.ddate) for r in out] == ["2020-02-29"]


def test_latest_rows_and_risk(spark):
    risk = spark.createDataFrame([("a", date(2020, 1, 1), "2020-02-29", "Post-paid", 1),
                                  ("b", date(2020, 1, 1), "2020-02-29", "Pre-paid", 1),
                                  ("c", date(2020, 1, 1), "2020-02-29", "Post-paid", 5),
                                  ("d", date(2020, 1, 1), "2020-01-31", "Post-paid", 1)],
                                 "analytic_id string, register_date date, ddate string, charge_type string, "
                                 "fraud_decile int")
    base = spark.createDataFrame([(k, date(2020, 1, 1)) for k in "abcde"], "analytic_id string, register_date date")
    assert reduce.exclude_risk(base, risk, 0).count() == 5
    assert sorted(r.analytic_id for r in reduce.exclude_risk(base, risk, 3).collect()) == ["b", "c", "d", "e"]
    assert sorted(r.analytic_id for r in reduce.exclude_risk(base, risk, 5).collect()) == ["b", "d", "e"]


def test_allow_list_of_any_size(spark):
    df = spark.createDataFrame([("x",), ("y",), ("z",)], "app string")
    allowed = spark.createDataFrame([("x",), ("z",), ("z",), (None,)], "v string")
    assert reduce.allow_list(df, "app", allowed, "v").count() == 2
    assert reduce.allow_list(df, "app", ["y"]).count() == 1
    many = spark.range(250_000).select(F.col("id").cast("string").alias("v"))
    rows = spark.range(100, 250_100, 50).select(F.col("id").cast("string").alias("app"))
    assert reduce.allow_list(rows, "app", many, "v").count() == 4998


def _py_unit(key: int, seed: int, purpose: str) -> float:
    return int(hashlib.md5(f"{purpose}|{seed}|{key}".encode()).hexdigest()[:8], 16) / 2**32


def test_hash_unit_matches_brute_force(spark):
    df = spark.range(0, 500).withColumn("u", sample.hash_unit(["id"], 567, "split"))
    for r in df.collect():
        assert r.u == _py_unit(r.id, 567, "split")
    assert spark.createDataFrame([(None,)], "id long").select(
        sample.hash_unit(["id"], 1, "sample").alias("u")).first().u < 1


def test_sampling_and_splitting_are_independent(spark):
    df = spark.range(0, 8000).withColumn("label", F.lit(0))
    down = sample.downsample(df, "label", {0: 0.5}, ["id"], seed=567)
    n = {r.split: r["count"] for r in sample.hash_split(down, ["id"], 0.75, 567).groupBy("split").count().collect()}
    assert 0.22 < n["test"] / (n["test"] + n["train"]) < 0.28


def test_downsample_and_split(spark):
    df = spark.range(0, 4000).withColumn("label", (F.col("id") % 4 == 0).cast("int"))
    down = sample.downsample(df, "label", {0: 0.5}, ["id"], seed=567)
    ones = down.filter("label = 1").count()
    zeros = down.filter("label = 0").count()
    assert ones == 1000 and 1350 < zeros < 1650
    again = sample.downsample(df.repartition(7), "label", {0: 0.5}, ["id"], seed=567)
    assert sorted(r.id for r in again.collect()) == sorted(r.id for r in down.collect())
    split = sample.hash_split(df, ["id"], 0.75, 567)
    share = split.filter("split = 'train'").count() / 4000
    assert 0.72 < share < 0.78
    exp = {i for i in range(4000) if _py_unit(i, 567, "split") < 0.75}
    assert {r.id for r in split.filter("split = 'train'").collect()} == exp
