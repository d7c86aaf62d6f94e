"""Cross-fitted target encoding of categorical predictors.

A category becomes the smoothed share of class 1 among its rows, one number
however many categories there are, so trees need no bin per category.  A
training row must not see its own label: rows are dealt to folds by a hash of
their key, and a row is encoded from the other folds only.  Rows that aren't
trained on are encoded from all of them.

Counts are whole numbers, combined before the shuffle.  A category that the
other folds don't have gets the overall share of those folds.  NULL is a
category of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FOLDS, SMOOTHING = 5, 20


def fold_of(keys: Sequence[str], seed: int, folds: int = FOLDS):
    """The fold of a row, from the leading bits of an MD5 over its keys."""
    text = F.concat_ws("|", F.lit("fold"), F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long"), F.lit(folds)).cast("int")


def fit(train: DataFrame, label_col: str, categorical: Sequence[str], keys: Sequence[str], folds: int = FOLDS,
        smoothing: int = SMOOTHING, seed: int = 567) -> DataFrame:
    """(feature, category, fold, value): a row per category and fold it may be
    encoded for; fold -1 is for rows that weren't trained on.  A NULL feature
    holds the shares of unseen categories."""
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category")) for c in categorical])
    tagged = train.select(fold_of(keys, seed, folds).alias("fold"), F.col(label_col).cast("long").alias("y"), F.inline(cells))
    per = tagged.groupBy("feature", "category", "fold").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos"))
    # the label's own counts: every row is in one cell of each predictor
    prior = (train.select(fold_of(keys, seed, folds).alias("fold"), F.col(label_col).cast("long").alias("y")).groupBy("fold")
             .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos")))
    every = F.explode(F.sequence(F.lit(-1), F.lit(folds - 1))).alias("out")
    keep = F.col("fold") != F.col("out")
    left_out = lambda d, by: (d.select("*", every).groupBy(*by, "out").agg(
        F.sum(F.when(keep, F.col("n")).otherwise(0)).alias("n"), F.sum(F.when(keep, F.col("pos")).otherwise(0)).alias("pos")))
    prior = left_out(prior, []).select("out", (F.col("pos") / F.when(F.col("n") > 0, F.col("n"))).alias("prior"))
    share = (F.col("pos") + F.lit(smoothing) * F.col("prior")) / (F.col("n") + F.lit(smoothing))
    seen = left_out(per, ["feature", "category"]).join(F.broadcast(prior), "out").select(
        "feature", "category", F.col("out").alias("fold"), share.alias("value"))
    unseen = prior.select(F.lit(None).cast("string").alias("feature"), F.lit(None).cast("string").alias("category"),
                          F.col("out").alias("fold"), F.col("prior").alias("value"))
    return seen.unionByName(unseen)


def transform(table: DataFrame, df: DataFrame, categorical: Sequence[str], keys: Sequence[str], training, folds: int = FOLDS,
              seed: int = 567, suffix: str = "_te") -> DataFrame:
    """``df`` with ``{column}{suffix}``; ``training`` says which rows were in the fit."""
    prior = {r.fold: r.value for r in table.filter("feature is null").select("fold", "value").collect()}     # folds + 1 rows
    out = df.withColumn("_fold", F.when(training, fold_of(keys, seed, folds)).otherwise(F.lit(-1)))
    unseen = F.lit(None).cast("double")
    for f, v in sorted(prior.items()):
        unseen = F.when(F.col("_fold") == f, F.lit(v)).otherwise(unseen)
    for c in categorical:
        of = (table.filter(F.col("feature") == c)
              .select(F.col("category").alias("_c"), F.col("fold").alias("_f"), F.col("value").alias(f"{c}{suffix}")))
        out = (out.join(of, F.col(c).cast("string").eqNullSafe(F.col("_c")) & (F.col("_fold") == F.col("_f")), "left")
               .drop("_c", "_f").withColumn(f"{c}{suffix}", F.coalesce(f"{c}{suffix}", unseen)))
    return out.drop("_fold")
