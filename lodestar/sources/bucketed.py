"""Tables stored by subscriber, so that joins and lags on it need no exchange.

Profile, pack and household mart meet on the same subscriber in the feature star
and again in the lag window.  Stored once in the same number of buckets, sorted
within them, all of those steps work bucket by bucket: the star's joins (the
month is a further join key), the union under the lag window and the
window itself.  Write such tables where a source is loaded each month; every
run after that saves its shuffles.

Two settings let Spark use a layout by fewer columns than an operator's keys;
``joined_by_bucket`` gives a session with them beside the caller's own.  A bucket
holds whole subscribers; a subscriber has a row per month, so none is hot.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from lodestar.session import session_with, shared_dir
from lodestar.sources.scratch import intermediate

SETTINGS = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",   # a join on (subscriber, month) over buckets of subscribers
    "spark.sql.unionOutputPartitioning": "true",                 # a union of equally bucketed tables is still bucketed
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "true",
}


def joined_by_bucket(spark: SparkSession) -> SparkSession:
    """A session over the same cluster and catalog, with ``SETTINGS``."""
    return session_with(spark, SETTINGS)


def store_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, spark: SparkSession | None = None) -> DataFrame:
    """Write ``df`` in ``buckets`` by ``keys`` to the shared folder and read it
    as a table of the catalog (in ``spark``, if another session is to read it).

    Rows are dealt by the same hash before the write, so each bucket is one
    sorted file.  Choose ``buckets`` so that one is some 200 MB at the table's
    size, the same for all tables that meet."""
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    path = intermediate(shared_dir(df.sparkSession, table))
    (df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table))
    return (spark or df.sparkSession).table(table)
