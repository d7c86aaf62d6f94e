from datetime import date

from pyspark.sql import functions as F

from lodestar.operators import evaluate, model
from lodestar.operators.campaign import LIST_COLUMNS, campaign_list
from lodestar.sources import tables


def _mart_rows(spark, months):
    return spark.createDataFrame([(f"id{i}", m, float(i)) for m in months for i in range(3)],
                                 "analytic_id string, ddate date, v double")


def test_append_months_edges(spark, tmp_dir):
    target = f"{tmp_dir}/mart"
    jan, feb, dec = date(2020, 1, 31), date(2020, 2, 29), date(2019, 12, 31)
    assert tables.append_months(_mart_rows(spark, [jan]), target) == 1          # empty mart
    assert tables.append_months(_mart_rows(spark, [jan, feb]), target) == 1     # jan already present
    assert tables.append_months(_mart_rows(spark, [dec]), target) == 1          # backfill older month
    assert tables.append_months(_mart_rows(spark, [jan]), target) == 0
    stored = tables.read_months(spark, target)
    assert stored.count() == 9
    assert sorted(str(r.ddate) for r in stored.select("ddate").distinct().collect()) == [
        "2019-12-31", "2020-01-31", "2020-02-29"]
    changed = _mart_rows(spark, [jan]).withColumn("v", F.col("v") + 100)
    assert tables.append_months(changed, target, replace=True) == 0    # no new month, one rewritten
    again = spark.read.parquet(target)
    assert again.count() == 9 and again.filter(F.col("v") >= 100).count() == 3


def test_update_mart_only_missing_months(spark, tmp_dir):
    from lodestar.plans.scoring import update_mart
    from lodestar.sources.standin import TestTables
    m = TestTables(spark, "/root/testdata/sf0.001").household_members()
    target = f"{tmp_dir}/hh"
    first = update_mart(m, target, date(1995, 6, 30))
    second = update_mart(m, target, date(1995, 8, 31))
    assert first >= 1 and second == 2
    assert update_mart(m, target, date(1995, 8, 31)) == 0
    stored = spark.read.parquet(target)
    exp = m.filter(F.col("ddate") <= F.lit(date(1995, 8, 31))).distinct().count()
    assert stored.count() == exp


def test_checkpoint_and_value_list(spark, tmp_dir):
    df = spark.range(10).withColumn("app", F.concat(F.lit("a"), (F.col("id") % 3).cast("string")))
    back = tables.checkpoint_table(df, f"{tmp_dir}/ck")
    assert back.count() == 10
    tables.write_value_list(df, "app", f"{tmp_dir}/apps")
    assert sorted(r.app for r in tables.read_value_list(spark, f"{tmp_dir}/apps", "app").collect()) == [
        "a0", "a1", "a2"]
    rows = tables.run_log_rows(params={"ntrees": 400}, metrics={"auc": 0.7}, run_id="r1")
    log = tables.write_run_log(spark, rows, f"{tmp_dir}/log")
    assert {(r.kind, r.key, r.value) for r in log.collect()} == {("param", "ntrees", "400"),
                                                                  ("metric", "auc", "0.7")}


def test_campaign_export_roundtrip(spark, tmp_dir):
    scored = spark.createDataFrame([(str(i), str(i), "2020-01-01", i / 20.0, "prime") for i in range(20)],
                                   "crm_sub_id string, analytic_id string, register_date string, "
                                   "p1 double, time2call string")
    cl = campaign_list(scored)
    assert cl.columns == LIST_COLUMNS
    best = cl.orderBy(F.desc("fmc_score")).first()
    assert (best.fmc_decile, best.fmc_percentile) == (1, 81)   # ntile(100) of 20 rows: buckets 1..20
    path = tables.export_list(cl, tmp_dir, date(2020, 3, 5))
    assert path.endswith("post_202003")
    import glob
    one = tables.export_list(cl, f"{tmp_dir}/one", date(2020, 3, 5), single_file=True)
    files = [f for f in glob.glob(f"{one}/*.csv")]
    assert len(files) == 1
    with open(files[0]) as fh:
        assert fh.readline().strip() == "|".join(LIST_COLUMNS)
    back = spark.read.option("header", True).option("sep", "|").csv(path)
    assert back.count() == 20


def test_roc_and_gains_brute_force(spark):
    rows = [(i, (i % 13) / 13.0, int(i % 3 == 0 or i % 13 > 9)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, score double, y int")
    roc = {r.threshold: r for r in evaluate.roc_table(df, "score", "y").collect()}
    P = sum(y for _, _, y in rows)
    for thr, r in roc.items():
        tp = sum(1 for _, s, y in rows if s >= thr and y == 1)
        assert r.tp == tp and abs(r.tpr - tp / P) < 1e-12
    assert len(roc) == 13 and len(evaluate.roc_table(df, "score", "y", digits=0).collect()) == 2
    auc = evaluate.auc_from_roc(df, "score", "y").first().auc
    pos = [s for _, s, y in rows if y]
    neg = [s for _, s, y in rows if not y]
    exact = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(auc - exact) < 1e-9
    g = evaluate.gains_lift(df, "score", "y", "id").orderBy("group").collect()
    assert [r.n for r in g] == [20] * 10
    assert g[-1].cum_positives == P and abs(g[-1].cum_capture - 1.0) < 1e-12
    assert abs(g[-1].cum_lift - 1.0) < 1e-12


def test_model_fit_score_persist(spark, tmp_dir):
    df = spark.range(400).select(
        F.col("id").alias("analytic_id"), (F.col("id") % 7).cast("double").alias("x"),
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("cat"),
        ((F.col("id") % 7) > 3).cast("int").alias("camp_response"))
    numeric, cats = model.predictors(df)
    assert numeric == ["x"] and cats == ["cat"]
    fitted = model.fit(df, "camp_response", numeric, cats, {"maxIter": 5, "maxDepth": 3})
    assert model.auc(fitted, df, "camp_response") > 0.9
    model.save_model(fitted, f"{tmp_dir}/model")
    again = model.load_model(f"{tmp_dir}/model")
    unseen = df.withColumn("cat", F.lit("zzz"))           # unseen category at scoring
    s = model.score(again, unseen, ["analytic_id"]).collect()
    assert all(0.0 <= r.p1 <= 1.0 and round(r.p1, 4) == r.p1 for r in s)
    imp = model.importance(spark, fitted, numeric, cats).collect()
    assert imp[0].feature == "x"


def test_hundred_categories_fit(spark):
    df = spark.range(1000).select(
        F.concat(F.lit("c"), F.col("id") % 100).alias("cat"), (F.col("id") % 3).cast("double").alias("x"),
        (F.col("id") % 100 > 60).cast("int").alias("camp_response"))
    fitted = model.fit(df, "camp_response", ["x"], ["cat"], {"maxIter": 2, "maxDepth": 3})
    assert fitted.stages[-1].getMaxBins() >= 101
    assert len(model.validation_loss(fitted, df, "camp_response")) == 2
    assert model.auc(fitted, df, "camp_response") > 0.9


def test_other_predictor_types_are_refused(spark):
    import pytest
    df = spark.createDataFrame([(1.0, date(2020, 1, 1))], "x double, d date")
    with pytest.raises(ValueError):
        model.predictors(df)


def test_unreadable_mart_raises(spark, tmp_dir):
    import pytest
    rows = spark.createDataFrame([(1, date(2020, 1, 31)), (2, date(2020, 2, 29))], "id int, ddate date")
    assert tables.stored_months(spark, f"{tmp_dir}/none") is None
    assert tables.append_months(rows, f"{tmp_dir}/mart", "ddate") == 2
    assert tables.append_months(rows, f"{tmp_dir}/mart", "ddate") == 0
    assert spark.read.parquet(f"{tmp_dir}/mart").count() == 2
    with pytest.raises(ValueError):
        tables.append_months(rows.withColumnRenamed("ddate", "month"), f"{tmp_dir}/mart", "month")
    rows.write.parquet(f"{tmp_dir}/file")
    import glob
    with pytest.raises(ValueError):
        tables.stored_months(spark, glob.glob(f"{tmp_dir.removeprefix('file://')}/file/*.parquet")[0])


def test_assert_unique(spark):
    import pytest

    from lodestar.operators.profile import assert_unique, duplicate_keys
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, m int")
    assert assert_unique(df, ["k", "m"]) is df
    with pytest.raises(ValueError):
        assert_unique(df, ["k"])
    assert [r.k for r in duplicate_keys(df, ["k"]).collect()] == ["a"]


def test_append_survives_a_crash(spark, tmp_dir, monkeypatch):
    """The append dies between staging and marker, at every step of a month;
    the next run stores the month whole and readers never see a part of it."""
    import pytest

    from lodestar.sources import months as m
    target, jan, feb, mar = f"{tmp_dir}/mart", date(2020, 1, 31), date(2020, 2, 29), date(2020, 3, 31)
    assert tables.append_months(_mart_rows(spark, [jan]), target) == 1
    publish, mark = m._publish, m._mark

    def dies(*a, **k):
        raise RuntimeError("killed")

    for name in ("_publish", "_mark"):
        monkeypatch.setattr(m, name, dies)
        with pytest.raises(RuntimeError):
            tables.append_months(_mart_rows(spark, [jan, feb, mar]), target)
        assert m.marked(spark, target) == ["2020-01-31"]
        assert tables.read_months(spark, target).count() == 3
        monkeypatch.setattr(m, "_publish", publish)
        monkeypatch.setattr(m, "_mark", mark)
    # what the dead append left in February's folder is only a part of the month
    folder = f"{target}/ddate=2020-02-29"
    assert tables.path_exists(spark, folder)
    spark.createDataFrame([("part", 0.5)], "analytic_id string, v double").write.mode("overwrite").parquet(folder)
    assert tables.append_months(_mart_rows(spark, [jan, feb, mar]), target) == 2
    got = tables.read_months(spark, target)
    assert got.count() == 9 and got.filter("analytic_id = 'part'").count() == 0
    assert not [n for n in m._names(spark, target) if n.startswith(m.STAGING)]
    assert tables.append_months(_mart_rows(spark, [feb]), target) == 0


def test_months_without_markers_are_adopted_not_overwritten(spark, tmp_dir):
    import pytest

    from lodestar.sources import months as m
    target = f"{tmp_dir}/old"
    _mart_rows(spark, [date(2020, 1, 31)]).write.partitionBy("ddate").parquet(target)
    with pytest.raises(ValueError, match="adopt_months"):
        tables.append_months(_mart_rows(spark, [date(2020, 1, 31)]), target)
    assert m.adopt_months(spark, target) == 1
    assert tables.append_months(_mart_rows(spark, [date(2020, 1, 31)]), target) == 0
    assert tables.read_months(spark, target).count() == 3


def test_rows_without_a_month_are_refused(spark, tmp_dir):
    import pytest
    rows = spark.createDataFrame([("a", None, 1.0)], "analytic_id string, ddate date, v double")
    with pytest.raises(ValueError):
        tables.append_months(rows, f"{tmp_dir}/mart")


def test_scratch_drops_intermediates_also_after_failure(spark, tmp_dir):
    import pytest

    from lodestar.sources.scratch import scratch
    df, path = spark.range(5), lambda n: f"{tmp_dir}/{n}"
    with scratch(spark):
        tables.checkpoint_table(df, path("a"))
        kept = tables.checkpoint_table(df, path("kept"), keep=True)
        with scratch(spark):
            tables.checkpoint_table(df, path("b"))
        assert tables.path_exists(spark, path("a")) and not tables.path_exists(spark, path("b"))
    with pytest.raises(RuntimeError):
        with scratch(spark):
            tables.checkpoint_table(df, path("c"))
            raise RuntimeError
    assert not any(tables.path_exists(spark, path(n)) for n in "abc") and kept.count() == 5
    tables.checkpoint_table(df, path("open"))
    assert tables.path_exists(spark, path("open"))
