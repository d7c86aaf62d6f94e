"""Month windows reach the scans of month-partitioned tables."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from lodestar.operators import derive, lags
from lodestar.plans import prepare, queries as Q
from lodestar.plans.training import Sources, check_histories
from lodestar.sources import tables
from lodestar.sources.standin import TestTables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark):
    from lodestar.session import shared_dir
    t = TestTables(spark, SF)
    return {n: tables.checkpoint_table(df, shared_dir(spark, f"months-{n}"), ["ddate"])
            for n, df in (("profile", t.profile()), ("pack", t.pack()))}


def _filters(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [x for x in plan.split("\n") if "PartitionFilters: [" in x and "PartitionFilters: []" not in x]


def test_population_prunes_months(stored):
    begin, end = date(1995, 11, 1), date(1996, 2, 29)
    got = _filters(prepare.population(stored["profile"], begin, end))
    assert got and all("1995-11-01" in x and "1996-03-01" in x for x in got)


def test_star_prunes_every_source(stored):
    begin, end = date(1995, 11, 1), date(1996, 2, 29)
    prof = prepare.population(stored["profile"], begin, end)
    house = stored["pack"].select("analytic_id", "ddate", F.lit(1.0).alias("x"))
    assert len(_filters(prepare.feature_table(prof, stored["pack"], house, begin, end))) >= 3


def test_lags_read_only_the_months_they_need(stored):
    base = stored["profile"].filter(F.col("ddate") == F.lit(date(1996, 4, 30))).select("analytic_id", "ddate")
    out = lags.month_lags(base, [(stored["pack"], Q.PACK_LAG_COLS)], month_bounds=(date(1996, 4, 30), date(1996, 4, 30)))
    assert any("1996-02-29" in x and "1996-03-31" in x for x in _filters(out))


def test_lags_use_one_exchange_and_no_join(stored):
    base = stored["profile"].select("analytic_id", "ddate")
    out = lags.month_lags(base, [(stored["profile"], Q.PROFILE_LAG_COLS), (stored["pack"], Q.PACK_LAG_COLS)])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_usage_pivot_uses_two_exchanges(spark):
    from lodestar.operators import pivot
    plan = pivot.usage_pivot(TestTables(spark, SF).hourly_usage())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def test_repeated_history_keys_are_found(stored):
    twice = stored["pack"].unionByName(stored["pack"])
    src = Sources(contacts=None, profile=stored["profile"], pack=stored["pack"], house=stored["pack"])
    check_histories(src)
    src.pack = twice
    with pytest.raises(ValueError):
        check_histories(src)


def test_derived_features_on_literal_values(spark):
    """Expected values written out by hand, not taken from the constants."""
    cols = {b for _, b in derive.AVG_FEATURES + derive.SLOPE_FEATURES}
    row = {c: 6.0 for c in cols} | {f"{c}_p1": 2.0 for c in cols} | {f"{c}_p2": 1.0 for c in cols}
    row |= {"mou_og_total_p1": 0.0, "mou_og_total_p2": 0.0, "norms_net_revenue_gprs": 9.0}
    r = derive.derive_features(spark.createDataFrame([row])).first()
    assert (r.avg_gprs, r.avg_vas, r.slope_mou_ic_total, r.slope_mou_og_total) == (4.0, 3.0, 3.0, 0.0)
    assert r.slope_household_person_count == 3.0 and len(r) == len(cols) + 29 + 32
