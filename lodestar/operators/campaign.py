"""The campaign list: score deciles/percentiles (1 = best) in a fixed layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.operators.rank import add_ntiles
from lodestar.operators.reduce import attach_call_time

# Fixed values (must equal the reference's export): constant columns and
# the output column order.
CHARGE_TYPE, MODEL_NAME = "Post-paid", "cvm"
LIST_COLUMNS = ["crm_sub_id", "analytic_id", "register_date", "fmc_score", "fmc_decile",
                "fmc_percentile", "charge_type", "model", "time2call"]


def campaign_list(scored: DataFrame, score_col: str = "p1", key: str = "analytic_id",
                  call_times: DataFrame | None = None, **kw) -> DataFrame:
    """Deciles and percentiles over the whole table, best scores first.

    ``call_times`` attaches the best time to call after the ranking, so the
    two passes of the ranking read the scores alone; without it ``scored``
    must carry ``time2call``.

    Ranks come from the distributed ntile ordered by (score, key), so ties
    are broken by the key and no single task sorts the whole table.
    """
    d = (scored.withColumnRenamed(score_col, "fmc_score")
         .withColumn("register_date", F.to_date("register_date")))
    d = add_ntiles(d, [("fmc_score", True), (key, True)],
                   {"fmc_decile": 10, "fmc_percentile": 100}, **kw)
    if call_times is not None:
        d = attach_call_time(d, call_times)
    d = (d.withColumn("fmc_decile", F.lit(11) - F.col("fmc_decile"))
         .withColumn("fmc_percentile", F.lit(101) - F.col("fmc_percentile"))
         .withColumn("charge_type", F.lit(CHARGE_TYPE))
         .withColumn("model", F.lit(MODEL_NAME)))
    return d.select(*LIST_COLUMNS)
