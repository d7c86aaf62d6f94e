"""Model evaluation tables: ROC points, AUC, gains/lift.

The ROC table has one row per distinct score, however many there are: scores
are counted with map-side combining, range-partitioned by score, summed
within each partition, and shifted by the sums of the partitions before (one
row per partition meets in one place).  The gains table ranks with the
distributed ntile and aggregates to one row per group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestar.operators.rank import add_ntiles, ranged_positions


def _points(scored: DataFrame, score_col: str, label_col: str, digits: int | None) -> DataFrame:
    """Per distinct score: counts, cumulative counts and the two totals."""
    score = F.col(score_col) if digits is None else F.round(F.col(score_col), digits)
    points = (scored.select(score.alias("threshold"), F.col(label_col).cast("long").alias("_y"))
              .groupBy("threshold").agg(F.sum("_y").alias("_pos"), F.count(F.lit(1)).alias("_cnt"))
              .withColumn("_neg", F.col("_cnt") - F.col("_pos")))
    pos = ranged_positions(points, [("threshold", False)])
    upto = Window.partitionBy("_pid").orderBy("_pos_in").rowsBetween(Window.unboundedPreceding, 0)
    parts = pos.groupBy("_pid").agg(F.sum("_pos").alias("_p"), F.sum("_neg").alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    parts = parts.select("_pid", F.coalesce(F.sum("_p").over(before), F.lit(0)).alias("_p0"),
                         F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
                         F.sum("_p").over(whole).alias("_P"), F.sum("_n").over(whole).alias("_N"))
    t = (pos.withColumn("_tp", F.sum("_pos").over(upto)).withColumn("_fp", F.sum("_neg").over(upto))
         .join(F.broadcast(parts), "_pid"))
    return t.select("threshold", "_pos", "_neg", (F.col("_tp") + F.col("_p0")).alias("tp"),
                    (F.col("_fp") + F.col("_n0")).alias("fp"), "_P", "_N")


def roc_table(scored: DataFrame, score_col: str, label_col: str, digits: int | None = None) -> DataFrame:
    """(threshold, tp, fp, tpr, fpr) per distinct score, best first.

    ``digits`` rounds the scores first (fewer points, merged thresholds)."""
    return _points(scored, score_col, label_col, digits).select(
        "threshold", "tp", "fp", (F.col("tp") / F.col("_P")).alias("tpr"), (F.col("fp") / F.col("_N")).alias("fpr"))


def auc_from_roc(scored: DataFrame, score_col: str, label_col: str) -> DataFrame:
    """Exact AUC (one row): the trapezoids under the exact ROC table.

    A distinct score with p positives and n negatives adds p (N - fp + n / 2)
    / (P N), fp counting the negatives down to it; all counts are whole, so
    twice the sum is exact."""
    twice = F.sum((F.col("_pos") * (2 * (F.col("_N") - F.col("fp")) + F.col("_neg"))).cast("decimal(38,0)"))
    return (_points(scored, score_col, label_col, None)
            .agg(twice.alias("_s"), F.max("_P").alias("_P"), F.max("_N").alias("_N"))
            .select((F.col("_s").cast("double") / (2.0 * F.col("_P") * F.col("_N"))).alias("auc")))


def gains_lift(scored: DataFrame, score_col: str, label_col: str, key,
               groups: int = 10, **kw) -> DataFrame:
    """Gains/lift by score group (1 = highest scores); ties go by ``key``, one
    column or several that together are unique.

    Per group: rows, positives, response rate, lift (rate / overall rate),
    cumulative rows, positives, capture rate and lift.
    """
    keys = [key] if isinstance(key, str) else list(key)
    ranked = add_ntiles(scored.select(*dict.fromkeys([*keys, score_col, label_col])),
                        [(score_col, False), *[(k, True) for k in keys]], {"group": groups}, **kw)
    per = (ranked.groupBy("group")
           .agg(F.count(F.lit(1)).alias("n"),
                F.sum(F.col(label_col).cast("long")).alias("positives"),
                F.min(score_col).alias("min_score"), F.max(score_col).alias("max_score")))
    upto = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, 0)
    all_rows = Window.partitionBy(F.lit(1))
    t = (per.withColumn("cum_n", F.sum("n").over(upto))
         .withColumn("cum_positives", F.sum("positives").over(upto))
         .withColumn("_tn", F.sum("n").over(all_rows))
         .withColumn("_tp", F.sum("positives").over(all_rows)))
    overall = F.col("_tp") / F.col("_tn")
    rate = F.col("positives") / F.col("n")
    return t.select(
        "group", "n", "positives", "min_score", "max_score",
        rate.alias("response_rate"),
        (rate / overall).alias("lift"),
        "cum_n", "cum_positives",
        (F.col("cum_positives") / F.col("_tp")).alias("cum_capture"),
        ((F.col("cum_positives") / F.col("cum_n")) / overall).alias("cum_lift"))
