"""Scoring flow: mart append -> prepare -> lags -> cleanse (saved means) ->
derive -> checkpoint -> risk exclusion -> score -> call time -> campaign list."""

from __future__ import annotations

from pyspark.ml.feature import ImputerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.months import month_end, month_start
from lodestar.operators import derive, household, impute, lags, model, reduce
from lodestar.operators.campaign import campaign_list
from lodestar.plans import prepare
from lodestar.plans.training import Sources, add_missing, history, zero_fill_cols
from lodestar.sources import tables
from lodestar.sources.scratch import scratch

SCORE_KEEP = ["crm_sub_id", "analytic_id", "register_date"]


def update_mart(members: DataFrame, target: str, through, month_col: str = "ddate") -> int:
    """Append every missing month <= ``through`` to the household mart.

    Members are reduced to the missing months before any statistic is
    computed, so a monthly run costs one month, not the whole history.
    """
    upto = members.filter(F.col(month_col) <= F.lit(through))
    stored = tables.stored_months(members.sparkSession, target, month_col)
    if stored is not None:
        upto = upto.join(F.broadcast(stored), month_col, "left_anti")
    mart = household.household_features(upto, partition_cols=[month_col])
    return tables.append_months(mart, target, month_col)


def build_features(src: Sources, as_of, app_values, work_dir: str, lag_shift: int = 0,
                   means: ImputerModel | None = None, allow_missing: bool = False):
    end = month_end(as_of, 1 + lag_shift)
    begin = month_start(as_of, 1 + lag_shift)
    prof = prepare.population(src.profile, begin, end, owners=src.owners)
    prof = tables.checkpoint_table(prof, f"{work_dir}/population")   # reused by every source
    feats = prepare.feature_table(prof, src.pack, src.house, begin, end,
                                  apps=src.apps, app_values=app_values, usage=src.usage)
    dt = lags.month_lags(feats, history(src), base_month="ddate", month_bounds=(end, end))
    dt = add_missing(dt, zero_fill_cols(app_values), allow_missing)
    ids = [c for c in model.ID_COLS if c != "camp_response"]
    clean, means = impute.cleanse(dt, ids, zero_fill_cols(app_values), means=means)
    final = derive.derive_features(clean)
    return tables.checkpoint_table(final, f"{work_dir}/scoring_features"), means


def saved_apps(spark, train_dir: str) -> list[str]:
    """The application list of the training run (a report-sized list)."""
    return sorted(r[0] for r in tables.read_value_list(spark, f"{train_dir}/training_apps", "application").collect())


def run_scoring(src: Sources, as_of, train_dir: str, work_dir: str, fraud_cut: int = 0, lag_shift: int = 0,
                out_dir: str | None = None, refit_means: bool = False, allow_missing: bool = False) -> DataFrame:
    """Score the month before ``as_of`` with the artifacts of a training run
    (model, means, application list under ``train_dir``) and write the
    campaign list.  ``refit_means`` fits the means on the scoring month.
    Scores and list stay; the intermediates are dropped at the end."""
    with scratch(src.profile.sparkSession):
        return _run_scoring(src, as_of, train_dir, work_dir, fraud_cut, lag_shift, out_dir, refit_means, allow_missing)


def _run_scoring(src, as_of, train_dir, work_dir, fraud_cut, lag_shift, out_dir, refit_means, allow_missing) -> DataFrame:
    spark = src.profile.sparkSession
    fitted = model.load_model(f"{train_dir}/model")
    means = None if refit_means else ImputerModel.load(f"{train_dir}/means")
    final, _ = build_features(src, as_of, saved_apps(spark, train_dir), work_dir, lag_shift, means, allow_missing)
    if src.fraud is not None:
        final = reduce.exclude_risk(final, src.fraud, fraud_cut)
    scored = model.score(fitted, final, SCORE_KEEP)
    score_path = f"{work_dir}/scores"
    tables.write_scores(scored, score_path)
    back = tables.read_delimited(spark, score_path, scored.schema, ",")
    if src.call_times is None:
        back = back.withColumn("time2call", F.lit("anytime"))
    cl = campaign_list(back, call_times=src.call_times)
    path = tables.export_list(cl, out_dir or f"{work_dir}/campaign", as_of)
    return tables.read_delimited(spark, path, cl.schema, "|")
