"""Boosted fit of one split, in closed form and exact.

A boosted tree of depth 1 on the log loss is a best split and two leaves, and
both follow from class counts: the split maximises the fall in Gini
impurity over all thresholds of all predictors, the leaves are one Newton step
from the prior log-odds.  Thresholds aren't binned: every distinct value is
tried, by running class counts over range partitions (``cumulative``).

A categorical predictor's categories are ordered by their share of class 1,
ties by name (the order in which the best subset of categories is a prefix), so it
needs no bin per category and may have any number of them.

NULL and NaN count as larger than any number; a NULL category is a category
of its own; a category that wasn't in the fit goes right.  Splits with equal
gain: the smaller predictor name, then the smaller threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestar.operators.cumulative import cumulative


def _number(col: str):
    top = F.lit(float("inf"))
    return F.coalesce(F.nanvl(F.col(col).cast("double"), top), top)


def class_counts(train: DataFrame, label_col: str, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """(feature, value, category, n, pos): class counts of every value of every
    predictor; a category's ``value`` is its share of class 1."""
    y, parts = F.col(label_col).cast("long").alias("_y"), []
    counts = [F.count(F.lit(1)).alias("n"), F.sum("_y").alias("pos")]
    if numeric:
        cells = F.array(*[F.struct(F.lit(c).alias("feature"), _number(c).alias("value")) for c in numeric])
        parts.append(train.select(y, F.inline(cells)).groupBy("feature", "value").agg(*counts)
                     .select("feature", "value", F.lit(None).cast("string").alias("category"), "n", "pos"))
    if categorical:
        cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category")) for c in categorical])
        parts.append(train.select(y, F.inline(cells)).groupBy("feature", "category").agg(*counts)
                     .select("feature", (F.col("pos") / F.col("n")).alias("value"), "category", "n", "pos"))
    if not parts:
        raise ValueError("a split needs a predictor")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def best_splits(counts: DataFrame) -> DataFrame:
    """One row a predictor with a split: the threshold (``value`` and, for
    categories, ``category``; both belong to the left), class counts of both
    sides, gain, whether it is the best of all, and its importance (the
    share of the tree's gain: all of it or none)."""
    run = cumulative(counts, ["feature"], [("value", True), ("category", True)], ["n", "pos"])
    share = lambda p, n: (F.col(p) * F.col(p)).cast("double") / F.col(n)
    cand = (run.filter(F.col("n_upto") < F.col("n_all"))
            .select("feature", "value", "category", F.col("n_upto").alias("n_left"), F.col("pos_upto").alias("pos_left"),
                    (F.col("n_all") - F.col("n_upto")).alias("n_right"), (F.col("pos_all") - F.col("pos_upto")).alias("pos_right"),
                    "n_all", "pos_all")
            .withColumn("gain", share("pos_left", "n_left") + share("pos_right", "n_right") - share("pos_all", "n_all")))
    side = ["n_left", "pos_left", "n_right", "pos_right", "gain"]
    per = (cand.groupBy("feature").agg(F.min(F.struct((-F.col("gain")).alias("least"), "value", "category", *side)).alias("top"))
           .select("feature", *[F.col(f"top.{c}").alias(c) for c in ("value", "category", *side)]))
    # one row a predictor: all of them fit in a task
    lead = F.min(F.struct((-F.col("gain")).alias("least"), "feature")).over(Window.partitionBy(F.lit(1)))
    best = F.col("feature") == lead["feature"]
    return per.withColumn("best", best).withColumn("importance", F.col("best").cast("double"))


def save(counts: DataFrame, splits: DataFrame, path: str) -> None:
    """Write the fit: ``split`` (one row) and ``left`` (the left categories)."""
    best = splits.filter("best").drop("best", "importance")
    best.write.mode("overwrite").parquet(f"{path}/split")
    best = splits.sparkSession.read.parquet(f"{path}/split").select("feature", F.col("value").alias("v"), F.col("category").alias("c"))
    left = (F.col("value") < F.col("v")) | ((F.col("value") == F.col("v")) & (F.col("category").isNull() | (F.col("category") <= F.col("c"))))
    (counts.join(F.broadcast(best), "feature").filter(left).select("feature", "category")
     .write.mode("overwrite").parquet(f"{path}/left"))


def load(spark: SparkSession, path: str):
    return spark.read.parquet(f"{path}/split").first(), spark.read.parquet(f"{path}/left")


def score(fit, df: DataFrame, categorical: Sequence[str], keep: Sequence[str], rate: float = 0.01, digits: int = 4,
          out_col: str = "p1") -> DataFrame:
    """Probability of class 1 by the loaded ``fit``, rounded, beside ``keep``."""
    if fit[0] is None:
        raise ValueError("no predictor has two values: there is no split to score by")
    split, cats = fit
    n, pos = split.n_left + split.n_right, split.pos_left + split.pos_right
    if not 0 < pos < n:
        raise ValueError("the fit has one class only")
    if split.feature in categorical:
        left = cats.select(F.col("category").alias("_c"), F.lit(True).alias("_left"))
        rows = df.join(left, F.col(split.feature).cast("string").eqNullSafe(F.col("_c")), "left")
        goes_left = F.coalesce("_left", F.lit(False))
    else:
        rows, goes_left = df, _number(split.feature) <= F.lit(split.value)
    p = F.lit(float(pos)) / F.lit(float(n))
    leaf = [(F.lit(float(a)) / F.lit(float(b)) - p) / (p * (1 - p)) for a, b in
            ((split.pos_left, split.n_left), (split.pos_right, split.n_right))]
    margin = F.ln(p / (1 - p)) + F.lit(rate) * F.when(goes_left, leaf[0]).otherwise(leaf[1])
    return rows.select(*keep, F.round(1 / (1 + F.exp(-margin)), digits).alias(out_col))
