from datetime import date

from pyspark.sql import functions as F

from lodestar.operators import household
from lodestar.sources.standin import TestTables
from lodestar.streaming import start_mart_stream


def test_mart_stream_incremental(spark, tmp_dir):
    members = TestTables(spark, "/root/testdata/sf0.001").household_members()
    months = [date(1996, 1, 31), date(1996, 2, 29), date(1996, 3, 31)]
    src, target, ck = f"{tmp_dir}/members", f"{tmp_dir}/mart", f"{tmp_dir}/ck"
    schema = members.schema
    # first delivery: January and half of February
    members.filter(F.col("ddate") == F.lit(months[0])).write.mode("append").parquet(src)
    feb = members.filter(F.col("ddate") == F.lit(months[1]))
    feb.filter(F.pmod(F.col("analytic_id"), F.lit(2)) == 0).write.mode("append").parquet(src)
    start_mart_stream(spark, src, target, ck, schema).awaitTermination()
    # second delivery: the rest of February and March
    feb.filter(F.pmod(F.col("analytic_id"), F.lit(2)) == 1).write.mode("append").parquet(src)
    members.filter(F.col("ddate") == F.lit(months[2])).write.mode("append").parquet(src)
    start_mart_stream(spark, src, target, ck, schema).awaitTermination()
    got = spark.read.parquet(target)
    exp = household.household_features(members.filter(F.col("ddate").isin(months)),
                                       partition_cols=["ddate"])
    cols = sorted(exp.columns)
    assert got.count() == exp.count()
    assert got.select(cols).exceptAll(exp.select(cols)).count() == 0
