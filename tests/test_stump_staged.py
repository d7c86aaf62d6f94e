"""The exact split, evaluation per tree and target encoding against plain versions."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lodestar.operators import encode, model, staged, stump
from lodestar.operators.cumulative import cumulative


def test_running_sums_of_one_huge_group_and_many_small_ones(spark):
    rows = [("big", i, i % 7) for i in range(3000)] + [(f"g{i}", j, j) for i in range(50) for j in range(4)]
    df = spark.createDataFrame(rows, "g string, k int, v long").repartition(9)
    got = {(r.g, r.k): (r.v_upto, r.v_all) for r in cumulative(df, ["g"], [("k", True)], ["v"]).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        total, mine = 0, sorted((k, v) for x, k, v in rows if x == g)
        for k, v in mine:
            total += v
            want[g, k] = (total, sum(x for _, x in mine))
    assert got == want


def plain_splits(rows, numeric, cats):
    """{feature: (gain, left rows)} by trying every threshold."""
    n, pos = len(rows), sum(r["y"] for r in rows)
    out = {}
    for f in numeric + cats:
        if f in cats:
            share = {c: sum(r["y"] for r in rows if r[f] == c) / sum(r[f] == c for r in rows) for c in {r[f] for r in rows}}
            rank = lambda r: (share[r[f]], r[f] is not None, r[f] or "")
        else:
            rank = lambda r: math.inf if r[f] is None or math.isnan(r[f]) else r[f]
        for t in sorted({rank(r) for r in rows})[:-1]:
            left = [r for r in rows if rank(r) <= t]
            nl, pl = len(left), sum(r["y"] for r in left)
            gain = pl * pl / nl + (pos - pl) ** 2 / (n - nl) - pos * pos / n
            if f not in out or gain > out[f][0]:
                out[f] = (gain, nl, pl)
    return out


def test_best_splits_are_those_of_all_thresholds(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(400):
        x, c = rng.choice([None, math.nan, *map(float, range(40))]), rng.choice([None, *[f"c{i}" for i in range(100)]])
        rows.append({"x": x, "z": rng.random(), "c": c, "one": "same", "y": int(rng.random() < (0.8 if (x or 0) > 20 else 0.3))})
    df = spark.createDataFrame(rows, "x double, z double, c string, one string, y int")
    counts = stump.class_counts(df, "y", ["x", "z"], ["c", "one"])
    got = {r.feature: r for r in stump.best_splits(counts).collect()}
    want = plain_splits(rows, ["x", "z"], ["c", "one"])
    assert set(got) == set(want) == {"x", "z", "c"}                    # a predictor of one value has no split
    for f, (gain, nl, pl) in want.items():
        assert got[f].gain == pytest.approx(gain) and (got[f].n_left, got[f].pos_left) == (nl, pl), f
    assert sum(r.best for r in got.values()) == 1 == sum(r.importance for r in got.values())


def test_scores_are_one_newton_step_and_unseen_goes_right(spark, tmp_dir):
    df = spark.createDataFrame([("a", 1)] * 6 + [("a", 0)] * 2 + [("b", 0)] * 7 + [("b", 1)], "c string, y int")
    counts = stump.class_counts(df, "y", [], ["c"])
    stump.save(counts, stump.best_splits(counts), f"{tmp_dir}/s")
    new = spark.createDataFrame([(1, "a"), (2, "b"), (3, "zz"), (4, None)], "id int, c string")
    got = {r.id: r.p1 for r in stump.score(stump.load(spark, f"{tmp_dir}/s"), new, ["c"], ["id"], rate=1.0).collect()}
    p = 7 / 16
    step = lambda share: round(1 / (1 + math.exp(-(math.log(p / (1 - p)) + (share - p) / (p * (1 - p))))), 4)
    assert got[2] == step(1 / 8) and got[1] == got[3] == got[4] == step(6 / 8)


def small_fit(spark):
    rng = random.Random(2)
    rows = [(i, float(rng.randint(0, 30)), rng.choice("abcde"), float(rng.random()), 0) for i in range(600)]
    rows = [(i, x, c, z, int(x / 30 + (c in "ab") * 0.4 + rng.random() * 0.5 > 0.9)) for i, x, c, z, _ in rows]
    df = spark.createDataFrame(rows, "id int, x double, c string, z double, y int").cache()
    fitted = model.fit(df.filter("id % 3 > 0"), "y", ["x", "z"], ["c"], {"maxIter": 6, "maxDepth": 4, "stepSize": 0.3})
    return fitted, df.filter("id % 3 = 0")


def test_staged_evaluation_is_that_of_every_tree(spark):
    fitted, test = small_fit(spark)
    got = {r.tree: r for r in staged.staged_evaluation(fitted, test, "y").collect()}
    assert sorted(got) == list(range(1, 7))
    for t, loss in enumerate(model.validation_loss(fitted, test, "y"), 1):
        assert got[t].log_loss == pytest.approx(loss, abs=1e-12)
    rows = staged.margins(fitted, test, "y").collect()
    for t in range(6):
        pos, neg = ([r.margins[t] for r in rows if r.y == y] for y in (1, 0))
        area = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
        assert got[t + 1].auc == pytest.approx(area, abs=1e-12)
    # the last margin is the model's own, unseen categories included
    unseen = test.withColumn("c", F.when(F.col("id") % 2 == 0, "never").otherwise(F.col("c")))
    own = model.score(fitted, unseen, ["id"], digits=None).orderBy("id").collect()
    mine = staged.margins(fitted, unseen.withColumn("y", F.col("id")), "y").orderBy("y").collect()
    for a, b in zip(own, mine):
        assert a.p1 == pytest.approx(1 / (1 + math.exp(-2 * b.margins[-1])), abs=1e-12)


def test_target_encoding_against_a_plain_one(spark):
    rng = random.Random(7)
    rows = [(i, rng.choice([None, "a", "b", "c"]), rng.randint(0, 1)) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, c string, y int")
    table = encode.fit(df, "y", ["c"], ["id"])
    folds = {r.id: r.f for r in df.select("id", encode.fold_of(["id"], 567).alias("f")).collect()}
    got = {r.id: r.c_te for r in encode.transform(table, df, ["c"], ["id"], F.lit(True)).collect()}
    for i, c, _ in rows:
        other = [(d, y) for j, d, y in rows if folds[j] != folds[i]]
        prior = sum(y for _, y in other) / len(other)
        mine = [y for d, y in other if d == c]
        assert got[i] == pytest.approx((sum(mine) + 20 * prior) / (len(mine) + 20), abs=1e-12)
    new = spark.createDataFrame([(1, "zz")], "id int, c string")
    (row,) = encode.transform(table, new, ["c"], ["id"], F.lit(False)).collect()
    assert row.c_te == pytest.approx(sum(y for *_, y in rows) / len(rows))


def test_wide_categories_fit_in_default_bins_without_leaking(spark):
    """Labels drawn at random: an encoding that saw its own row's label would
    tell the training rows apart; a cross-fitted one can't."""
    df = (spark.range(6000).select("id", F.concat(F.lit("k"), F.pmod(F.xxhash64("id"), F.lit(3000))).alias("c"), F.rand(3).alias("x"))
          .withColumn("y", F.pmod(F.xxhash64("id", F.lit(9)), F.lit(2)).cast("int")))
    fitted, table, wide = model.fit_encoded(df, "y", ["x"], ["c"], ["id"], params={"maxIter": 3, "maxDepth": 3, "stepSize": 0.5})
    assert wide == ["c"] and fitted.stages[-1].getMaxBins() == 32
    data = encode.transform(table, df, wide, ["id"], F.lit(True))
    assert abs(data.stat.corr("c_te", "y")) < 0.05
    own = df.join(df.groupBy("c").agg(F.avg("y").alias("own")), "c")
    assert own.stat.corr("own", "y") > 0.5                        # what leaking looks like
    new = encode.transform(table, df, wide, ["id"], F.lit(False))
    assert model.score(fitted, new, ["id"]).count() == 6000
