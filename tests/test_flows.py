from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from lodestar.functions.months import month_end
from lodestar.operators.campaign import LIST_COLUMNS
from lodestar.plans import queries as Q
from lodestar.plans.scoring import run_scoring
from lodestar.plans.training import run_training, zero_fill_cols
from lodestar.sources.standin import TestTables

SF = "/root/testdata/sf0.01"


def test_training_then_scoring(spark, tmp_dir):
    t = TestTables(spark, SF)
    src = Q._sources(t, tmp_dir, month_end(Q.SCORE_AS_OF, 1))
    train_dir = f"{tmp_dir}/train"
    out = run_training(spark, src, Q.TRAIN_AS_OF, Q.APP_LIST, train_dir,
                       gbt_params={"maxIter": 5, "maxDepth": 3})
    final = out["features"]
    n = final.count()
    assert n > 100
    # cleansing keeps the rows: one per labelled subscriber with a profile id
    labels = out["features"].select("crm_sub_id", "camp_response").distinct().count()
    assert labels == n
    zero_cols = [c for c in zero_fill_cols(Q.APP_LIST) if c in final.columns]
    nulls = final.select(*[F.sum(F.col(f"`{c}`").isNull().cast("int")).alias(c) for c in zero_cols[:40]]).first()
    assert all(v == 0 for v in nulls.asDict().values())
    from lodestar.plans.training import LAG_BASES
    lag_cols = {f"{b}_p{k}" for b in LAG_BASES for k in (1, 2)}
    assert not lag_cols & set(final.columns)
    assert {"avg_gprs", "slope_net_rev", "serenade"} <= set(final.columns)
    # both labels in both parts, so the hold-out figures mean something
    m = out["metrics"]
    assert all(m[f"n_{part}_{y}"] > 0 for part in ("train", "test") for y in (0, 1)), m
    assert m["n_test_0"] == out["scored_test"].filter("camp_response = 0").count()
    assert 0.0 < m["auc"] < 1.0
    gains = out["gains"].collect()
    assert len(gains) == 10 and len({round(g.lift, 6) for g in gains}) > 1
    roc = spark.read.parquet(f"{train_dir}/roc")
    last = roc.orderBy("threshold").first()
    assert (last.tpr, last.fpr) == (1.0, 1.0)
    assert spark.read.parquet(f"{train_dir}/validation_loss").count() == 5
    # every source contributes: profile, pack, household, apps, usage
    from lodestar.operators import household, pivot
    from lodestar.plans.training import PACK_NUMERIC, PROFILE_LAG_COLS
    groups = {"profile": PROFILE_LAG_COLS, "pack": PACK_NUMERIC, "household": household.HOUSEHOLD_COLS,
              "apps": [f"{a}_{s}" for _, _, s in pivot.APP_MEASURES for a in Q.APP_LIST],
              "usage": [f"{wp}_{x}" for x in pivot.USAGE_PIVOT_ORDER for wp in pivot.WEEKDAY_PERIODS]}
    for name, cols in groups.items():
        total = final.select(sum((F.abs(F.col(f"`{c}`")) for c in cols if c in final.columns), F.lit(0.0)).alias("x")).agg(F.sum("x")).first()[0]
        assert total > 0, name
    log = {(r.kind, r.key) for r in spark.read.parquet(f"{train_dir}/run_log").collect()}
    assert {("metric", "auc"), ("param", "maxIter"), ("param", "profile_month"),
            ("artifact", "importance"), ("artifact", "gains_lift"), ("artifact", "roc")} <= log
    assert spark.read.parquet(f"{train_dir}/importance").count() > 0
    # scoring reads model, means and application list from the training folder
    camp = run_scoring(src, Q.SCORE_AS_OF, train_dir, tmp_dir)
    assert camp.columns == LIST_COLUMNS
    rows = camp.collect()
    assert len(rows) > 0
    assert {int(r.fmc_decile) for r in rows} <= set(range(1, 11))
    assert {r.charge_type for r in rows} == {"Post-paid"} and {r.model for r in rows} == {"cvm"}
    assert len({r.analytic_id for r in rows}) == len(rows)
    assert dict(camp.dtypes)["fmc_score"] == "double" and dict(camp.dtypes)["analytic_id"] == "bigint"
    # a forgotten source is an error, not zeros
    with pytest.raises(ValueError):
        run_scoring(replace(src, usage=None), Q.SCORE_AS_OF, train_dir, f"{tmp_dir}/again")
    # the mart holds every month up to the scoring month, written once each
    mart = spark.read.parquet(f"{tmp_dir}/hh_mart")
    assert mart.agg(F.max("ddate")).first()[0] == date(1996, 5, 31)
