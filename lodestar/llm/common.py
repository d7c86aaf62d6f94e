"""Shared Spark helpers of the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.session import shared_dir
from lodestar.sources.scratch import intermediate

BATCH_LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": 2500, "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20}
ROW_GROUP_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read by Spark only (the path may be any store)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def stored(df: DataFrame, name: str, keep: bool = False, **options) -> DataFrame:
    """Write a table to the shared checkpoint folder and read it back.

    The lineage ends there, so a lost executor never recomputes the steps
    before it, and readers on any executor see the files.  Row groups are small,
    as a task holds one while it writes.  An open ``scratch`` scope drops the
    folder at its end, unless it is to be kept."""
    path = shared_dir(df.sparkSession, f"{name}-{uuid.uuid4().hex[:12]}")
    path = path if keep else intermediate(path)
    df.write.options(**{"parquet.block.size": ROW_GROUP_BYTES, **options}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(df: DataFrame, text: str = "text") -> int:
    """Total bytes of text: one pruned scan, one number to the driver."""
    return df.select(F.coalesce(F.sum(F.octet_length(F.col(text))), F.lit(0))).first()[0]


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches within ``BATCH_LIMITS`` (rows and bytes) from here on:
    batches of whole texts are what fills an executor's memory outside the heap.
    The session keeps smaller settings of its own."""
    for name, most in BATCH_LIMITS.items():
        now = spark.conf.get(name).lower()
        now = int(now.rstrip("b")) if now.rstrip("b").lstrip("-").isdigit() else most + 1
        if now > most or now <= 0:
            spark.conf.set(name, str(most))


FILTER_BITS = 1 << 23


def possible(rows: DataFrame, key, members: DataFrame, member_key, bits: int = FILTER_BITS) -> DataFrame:
    """``rows`` with ``_maybe``: false only where ``key`` is in no row of
    ``members``.  The members set bits of a bitmap of fixed size (1 MB, the one
    thing broadcast), so wide rows that can't match never enter a join."""
    def slot(k):
        return F.pmod(F.xxhash64(k), F.lit(bits)) + 1

    bitmap = members.select(slot(member_key).alias("_slot")).groupBy(F.bitmap_bucket_number("_slot").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias("_bits"))
    byte = F.expr("cast(conv(hex(substring(_bits, cast(_at div 8 as int) + 1, 1)), 16, 10) as int)")
    hit = F.coalesce(byte.bitwiseAND(F.expr("shiftleft(1, cast(_at % 8 as int))")) != 0, F.lit(False))
    return (rows.withColumns({"_bucket": F.bitmap_bucket_number(slot(key)), "_at": F.bitmap_bit_position(slot(key))})
            .join(F.broadcast(bitmap), "_bucket", "left").withColumn("_maybe", hit).drop("_bucket", "_at", "_bits"))


def without(rows: DataFrame, key, members: DataFrame, member_key, others: DataFrame | None = None, other_key=None,
            bits: int = FILTER_BITS) -> DataFrame:
    """``rows`` whose key is in no row of ``members`` (null keys stay).  Only
    rows that the bitmap can't clear are shuffled.

    ``others``, a narrow table with every key of ``rows`` that isn't a member's
    (more do no harm), spares the members' rows the shuffle too: the keys among
    them that the first bitmap mistakes for members set a second one, and a row
    that passes the first but not the second is a member's."""
    marked = possible(rows, key, members, member_key, bits)
    unsure = marked.filter("_maybe").drop("_maybe")
    if others is not None:
        mistaken = (possible(others.select(other_key.alias("_other")), F.col("_other"), members, member_key, bits)
                    .filter("_maybe").select("_other").join(members, F.col("_other") == member_key, "left_anti"))
        unsure = possible(unsure, key, mistaken, F.col("_other"), bits).filter("_maybe").drop("_maybe")
    unsure = unsure.join(members, key == member_key, "left_anti")
    return marked.filter("not _maybe").drop("_maybe").unionByName(unsure)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): smallest node reachable, for every node of ``edges``.

    Alternating large-star and small-star steps: each step links a node's
    neighbours to the smallest of them, so the edge count never grows and a
    chain shrinks to a star in a logarithmic number of rounds.  Every step is
    a grouped minimum (combined before the shuffle) and a join back; each
    round ends in a stored table.  Only two numbers a round reach the driver."""
    cur = stored(edges.select(F.least(a, b).alias("v"), F.greatest(a, b).alias("u"))
                 .filter("u <> v").distinct(), "edges")
    last = None
    while True:
        state = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == last or state[0] == 0:
            break
        last = tuple(state)
        both = cur.select("u", "v").unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        cur = stored(small, "edges")
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
