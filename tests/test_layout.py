"""Tables stored by subscriber, and the latest snapshot from metadata."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lodestar.operators import lags, reduce
from lodestar.plans import queries as Q
from lodestar.sources import tables
from lodestar.sources.bucketed import joined_by_bucket, store_bucketed
from lodestar.sources.scratch import scratch


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_star_and_lags_need_no_exchange(spark):
    before = spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition")
    star, lagged = Q.bucketed_star(spark, SF_SMALL)
    no_broadcast = lagged.sparkSession
    no_broadcast.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for df in Q.bucketed_star(spark, SF_SMALL):
        df.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        text = plan(df.select("*"))
        assert "Exchange" not in text and "SortMergeJoin" in text, text[:2000]
        df.collect()
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == before
    plain = Q.QUERIES["lag_features"](spark, SF_SMALL)
    shared = [c for c in plain.columns if c in lagged.columns]
    assert len(shared) > 60
    assert sorted(map(str, plain.select(shared).collect())) == sorted(map(str, lagged.select(shared).collect()))


def test_duplicates_fail_over_buckets_too(spark):
    from pyspark.errors import PySparkException
    other = joined_by_bucket(spark)
    rows = [(k, date(2020, m, 28), m) for k in range(20) for m in (1,)] + [(3, date(2020, 1, 28), 9)]
    with scratch(spark):
        hist = store_bucketed(spark.createDataFrame(rows, "k int, ddate date, v int"), "hist", ["k"], 4, other)
        base = other.createDataFrame([(3, date(2020, 2, 29))], "k int, ddate date")
        with pytest.raises(PySparkException, match="several rows"):
            lags.month_lags(base, [(hist, ["v"])], keys=["k"]).collect()


def test_latest_rows_from_footers(spark, tmp_dir):
    path = f"{tmp_dir}/snap"
    (spark.range(3000).select("id", F.expr("date_add(date'2020-01-01', cast(id div 1000 as int))").alias("d"))
     .repartition(3, "d").write.parquet(path))
    got = reduce.latest_of_files(spark, path, "d")
    assert got.count() == 1000 and got.agg(F.min("id")).first()[0] == 2000
    assert "PushedFilters: [IsNotNull(d), EqualTo(d,2020-01-03)]" in plan(got)
    meta = spark.newSession()
    meta.conf.set("spark.sql.sources.useV1SourceList", "")
    meta.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    assert "PushedAggregation: [MAX(d)]" in plan(reduce.latest_value(meta.read.parquet(path), "d"))
    spark.range(0).select("id", F.lit(None).cast("date").alias("d")).write.parquet(f"{tmp_dir}/none")
    assert reduce.latest_of_files(spark, f"{tmp_dir}/none", "d").count() == 0


def test_latest_month_prunes_to_its_folder(spark, tmp_dir):
    rows = spark.createDataFrame([(i, date(2020, m, 28)) for i in range(4) for m in (1, 2, 3)], "id int, ddate date")
    tables.append_months(rows, f"{tmp_dir}/mart")
    got = tables.latest_month(spark, f"{tmp_dir}/mart")
    assert got.count() == 4 and "PartitionFilters: [isnotnull(ddate" in plan(got)
    assert {f.rsplit("/", 2)[1] for f in got.inputFiles()} == {"ddate=2020-03-28"}
