"""Training flow: label -> prepare -> lags -> cleanse -> derive -> checkpoint -> model.

Inputs are DataFrames in the reference's table roles (``Sources``); the
flow is one lazy plan up to the checkpoint, which is written as Parquet in
the shared folder and re-read, so the model fit (many passes over the
data) never recomputes the joins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.months import month_end
from lodestar.operators import derive, household, impute, label, lags, model, pivot, sample
from lodestar.operators.evaluate import auc_from_roc, gains_lift, roc_table
from lodestar.operators.profile import assert_unique
from lodestar.plans import prepare
from lodestar.operators.staged import staged_evaluation
from lodestar.sources import tables
from lodestar.sources.scratch import scratch

PROFILE_LAG_COLS = ["norms_net_revenue_avg_3mth_p0_p2", "norms_net_revenue_gprs",
                    "norms_net_revenue_vas", "norms_net_revenue_voice"]
PACK_LAG_COLS = ["data_traffic_subs_mb", "mou_ic_total", "mou_og_total", "distinct_out_number"]
PACK_NUMERIC = [c for c in prepare.PACK_COLS if c not in ("analytic_id", "ddate", "new_pack_cat")]
LAG_BASES = PROFILE_LAG_COLS + household.HOUSEHOLD_COLS + PACK_LAG_COLS


@dataclass
class Sources:
    """The reference's input tables as DataFrames."""
    contacts: DataFrame
    profile: DataFrame
    pack: DataFrame
    house: DataFrame          # household mart (analytic_id, register_date, ..., ddate)
    apps: DataFrame | None = None
    usage: DataFrame | None = None
    owners: DataFrame | None = None
    fraud: DataFrame | None = None
    call_times: DataFrame | None = None


def zero_fill_cols(app_values) -> list[str]:
    """Numeric feature groups that are zero-filled, built from constants."""
    apps = [f"{a}_{s}" for _, _, s in pivot.APP_MEASURES for a in app_values]
    usage = [f"{wp}_{m}" for m in pivot.USAGE_PIVOT_ORDER for wp in pivot.WEEKDAY_PERIODS]
    lag_cols = [lags.lag_name(c, k) for k in (1, 2) for c in LAG_BASES]
    return (["days_active", "service_month"] + PROFILE_LAG_COLS + PACK_NUMERIC
            + household.HOUSEHOLD_COLS + apps + usage + lag_cols)


def add_missing(df: DataFrame, cols, allowed: bool) -> DataFrame:
    """NULL double columns for feature groups a run has no source for; only
    where the caller ``allowed`` that (scoring must match the training run)."""
    missing = [c for c in cols if c not in df.columns]
    if missing and not allowed:
        raise ValueError(f"{len(missing)} feature columns have no source, such as {missing[0]}; "
                         "pass the missing table or allow_missing=True")
    return df.select("*", *[F.lit(None).cast("double").alias(c) for c in missing])


def history(src: Sources):
    return [(src.profile, PROFILE_LAG_COLS), (src.house, household.HOUSEHOLD_COLS),
            (src.pack, PACK_LAG_COLS)]


def check_histories(src: Sources) -> None:
    """Every join and lag takes profile, household mart and pack as unique on
    (subscriber, month); this reads them once each and raises if they aren't."""
    for table in (src.profile, src.house, src.pack):
        assert_unique(table, ["analytic_id", "ddate"])


def build_features(src: Sources, as_of, app_values, work_dir: str, lag_shift: int = 0,
                   label_mode: str = "earliest", means=None, allow_missing: bool = False,
                   check_keys: bool = False):
    """Labelled, cleansed, derived training table (checkpointed) and fitted means."""
    if check_keys:
        check_histories(src)
    lb, le = label.label_window(as_of, 1 + lag_shift)
    labels = label.campaign_labels(src.contacts, src.profile, lb, le, mode=label_mode)
    # The labels and the reduced population are read by every later step
    # (semi joins of each source, the star, the means fit); writing them once
    # keeps those reads to a scan of a small table instead of re-running the
    # label and profile plans, and survives executor loss.
    labels = tables.checkpoint_table(labels, f"{work_dir}/labels")
    begin, end = prepare.feature_window(as_of, 4 + lag_shift, training=True)
    prof = prepare.population(src.profile, begin, end, labels=labels)
    prof = tables.checkpoint_table(prof, f"{work_dir}/population")
    feats = prepare.feature_table(prof, src.pack, src.house, begin, end,
                                  apps=src.apps, app_values=app_values, usage=src.usage)
    dt = prepare.label_features(labels, feats)
    dt = lags.month_lags(dt, history(src), base_month="prof_month",
                         month_bounds=(month_end(begin), end))
    dt = add_missing(dt, zero_fill_cols(app_values), allow_missing)
    if means is None:
        # Fit on the three profile columns only: every other join is a
        # unique-key left join, so the rows are the same, and the fit pass
        # does not re-run the whole feature plan.
        narrow = prepare.label_features(
            labels, prof.select("analytic_id", "crm_sub_id", "ddate", *impute.MEAN_COLS))
        means = impute.fit_means(impute.prepare_numbers(narrow))
    clean, means = impute.cleanse(dt, model.ID_COLS, zero_fill_cols(app_values), means=means)
    final = derive.derive_features(clean)
    final = tables.checkpoint_table(final, f"{work_dir}/training_features", keep=True)
    return final, means


def train(final: DataFrame, label_col: str = "camp_response", sample_frac: float = 0.5,
          seed: int = model.SPLIT_SEED, gbt_params: dict | None = None):
    """Down-sample label 0, split 75/25 by key hash, fit, evaluate.

    Returns (pipeline model, test predictions-ready frame, metrics dict,
    numeric predictors, categorical predictors).  Both parts must hold both
    labels, or no figure of the hold-out means anything.
    """
    down = sample.downsample(final, label_col, {0: sample_frac}, ["crm_sub_id", "analytic_id"], seed)
    split = sample.hash_split(down, ["crm_sub_id", "analytic_id"], model.SPLIT_RATIO, seed)
    sizes = {(r["split"], r[label_col]): r["count"] for r in split.groupBy("split", label_col).count().collect()}
    for part in ("train", "test"):
        for y in (0, 1):
            if not sizes.get((part, y)):
                raise ValueError(f"the {part} part has no rows with label {y}: {sizes}")
    numeric, cats = model.predictors(final)
    train_df = split.filter("split = 'train'")
    test_df = split.filter("split = 'test'")
    fitted = model.fit(train_df, label_col, numeric, cats, gbt_params)
    exact = auc_from_roc(model.score(fitted, test_df, [label_col], digits=None), "p1", label_col)
    metrics = {"auc": float(exact.first()["auc"])}
    metrics |= {f"n_{part}_{y}": n for (part, y), n in sizes.items()}
    return fitted, test_df, metrics, numeric, cats


def run_training(spark, src: Sources, as_of, app_values, work_dir: str, lag_shift: int = 0,
                 gbt_params: dict | None = None, sample_frac: float = 0.5, allow_missing: bool = False) -> dict:
    """The whole training flow; saves model, means and app list under ``work_dir``.

    Its results are the written artifacts, read back; the intermediates of all
    steps are dropped at the end, also after a failure."""
    with scratch(spark):
        return _run_training(spark, src, as_of, app_values, work_dir, lag_shift, gbt_params, sample_frac, allow_missing)


def _run_training(spark, src, as_of, app_values, work_dir, lag_shift, gbt_params, sample_frac, allow_missing) -> dict:
    # the columns of the features are those of the whole list, seen or not
    listed = spark.createDataFrame([(a,) for a in app_values], "application string")
    tables.write_value_list(listed, "application", f"{work_dir}/training_apps")
    final, means = build_features(src, as_of, app_values, work_dir, lag_shift, allow_missing=allow_missing)
    fitted, test_df, metrics, numeric, cats = train(final, sample_frac=sample_frac,
                                                     gbt_params=gbt_params)
    model.save_model(fitted, f"{work_dir}/model")
    means.write().overwrite().save(f"{work_dir}/means")
    scored = model.score(fitted, test_df, ["crm_sub_id", "analytic_id", "camp_response"])
    scored = tables.checkpoint_table(scored, f"{work_dir}/scored_test", keep=True)
    # rows that tie on all of these count alike in every group
    gains = gains_lift(scored, "p1", "camp_response", ["analytic_id", "crm_sub_id", "camp_response"])
    roc = roc_table(scored, "p1", "camp_response")
    loss = staged_evaluation(fitted, test_df, "camp_response")         # loss and AUC after each tree
    imp = model.importance(spark, fitted, numeric, cats)
    # artifacts: small tables (one row per score group / per feature)
    gains, imp, roc, loss = (tables.checkpoint_table(df, f"{work_dir}/{name}", keep=True) for name, df in
                             (("gains_lift", gains), ("importance", imp), ("roc", roc), ("validation_loss", loss)))
    params = dict(model.GBT_PARAMS, **(gbt_params or {}))
    first = month_end(as_of, 4 + lag_shift)
    params["profile_month"] = f"{first} - {month_end(as_of, 3 + lag_shift)}"
    log = tables.run_log_rows(params=params, metrics=metrics,
                              artifacts={"features": ",".join(numeric + cats),
                                         "gains_lift": f"{work_dir}/gains_lift", "roc": f"{work_dir}/roc",
                                         "validation_loss": f"{work_dir}/validation_loss",
                                         "importance": f"{work_dir}/importance",
                                         "model": f"{work_dir}/model"})
    tables.write_run_log(spark, log, f"{work_dir}/run_log")
    return {"features": final, "model": fitted, "means": means, "metrics": metrics,
            "gains": gains, "importance": imp, "scored_test": scored, "roc": roc, "validation_loss": loss}
