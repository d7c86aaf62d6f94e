"""Deterministic sampling and splitting by key hash.

A row's fate depends only on its key, a seed and the purpose of the draw, not
on partitioning or task order, so a recomputed partition after an executor
loss, or a rerun, selects exactly the same rows -- unlike ``sample`` /
``randomSplit``, whose draws depend on partition layout.  One filter, no
shuffle, no union.  The purpose keeps draws independent: a row kept by
down-sampling is as likely as any other to reach either part of a split.
The hash is the leading 32 bits of an MD5 over text, so any SQL engine can
compute the same draw.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_unit(keys: Sequence[str], seed: int, purpose: str) -> Column:
    """A number in [0, 1) from the purpose, the seed and the keys (as text,
    null as the empty text).  Rows whose keys are all null are drawn by the whole
    row instead, or they would share one draw and a class could go as one."""
    null = F.lit(True)
    for k in keys:
        null = null & F.col(k).isNull()
    row = F.when(null, F.concat(F.lit("|"), F.xxhash64(F.struct("*")).cast("string"))).otherwise("")
    text = F.concat(F.concat_ws("|", F.lit(purpose), F.lit(str(seed)),
                                *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]), row)
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def downsample(df: DataFrame, label_col: str, fractions: dict, keys: Sequence[str],
               seed: int = 567) -> DataFrame:
    """Keep each label's rows with the given fraction (labels not listed: all)."""
    frac = F.lit(1.0)
    for label, f in sorted(fractions.items(), reverse=True):
        frac = F.when(F.col(label_col) == F.lit(label), F.lit(float(f))).otherwise(frac)
    return df.filter(hash_unit(keys, seed, "sample") < frac)


def hash_split(df: DataFrame, keys: Sequence[str], ratio: float = 0.75, seed: int = 567,
               out_col: str = "split") -> DataFrame:
    """Tag rows "train" (share ``ratio``) or "test"."""
    return df.withColumn(out_col, F.when(hash_unit(keys, seed, "split") < F.lit(float(ratio)), "train")
                         .otherwise("test"))
