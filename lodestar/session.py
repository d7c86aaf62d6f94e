"""Session helpers for tests, the bench and local runs.

Library code never builds a session: callers pass ``spark``.  On a
cluster the checkpoint folder comes from ``spark.checkpoint.dir``; only
local runs (tests, bench) set one, and only when it is unset.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_LOCAL_DIRS: dict[str, str] = {}
_SHIPPED: set[str] = set()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "lodestar", extra: dict | None = None) -> SparkSession:
    """A local session with AQE on and the UI off (tests and bench)."""
    extra = dict(extra or {})
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LODESTAR_DRIVER_MEMORY", "16g"))
    )
    if CHECKPOINT_CONF not in extra and os.environ.get("LODESTAR_CHECKPOINT_DIR"):
        extra[CHECKPOINT_CONF] = os.environ["LODESTAR_CHECKPOINT_DIR"]
    for k, v in extra.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only when unset.

    A cluster names its shared folder in ``spark.checkpoint.dir``; that value
    is always used as is.  A local run without one (tests) gets a fresh
    folder under /tmp so ``DataFrame.checkpoint()`` and written tables work.
    """
    sc = spark.sparkContext
    base = sc.getConf().get(CHECKPOINT_CONF, None)
    if not base:
        base = _LOCAL_DIRS.get(sc.applicationId)
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set; a cluster run needs a shared folder there")
        base = tempfile.mkdtemp(prefix="lodestar-ckpt-", dir="/tmp")
        _LOCAL_DIRS[sc.applicationId] = base
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the executors, once per application, so task
    functions can import it wherever the driver was started from."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    buffer = Path(tempfile.mkdtemp(prefix="lodestar-code-")) / f"{root.name}.zip"
    with zipfile.ZipFile(buffer, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(buffer))
    _SHIPPED.add(sc.applicationId)


def session_with(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session over the same cluster and catalog, with the caller's settings and ``settings``."""
    other = spark.newSession()
    for k, v in {**spark.conf.getAll, **settings}.items():
        if k.startswith("spark.sql.") and spark.conf.isModifiable(k):
            other.conf.set(k, v)
    return other


# HotSpot compiles no method beyond 8000 bytes of code: a generated one that holds a
# hundred expressions would be interpreted for every row.  Spark then makes small ones.
WIDE_ROWS = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def shared_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder, for written tables."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"


def cluster_settings(input_bytes: int, total_cores: int,
                     target_partition_bytes: int = 200 * 1024 * 1024) -> dict[str, str]:
    """Settings sized to the data, for a cluster session builder.

    Shuffle partitions follow the widest stage's input (about
    ``target_partition_bytes`` per partition, at least two waves of tasks),
    so a partition fits in executor memory without spilling at 100 TB and
    AQE can still coalesce small ones.  Skew joins and partition coalescing
    stay on; the broadcast threshold is left at a size whose build side is
    safe on every executor.
    """
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }
