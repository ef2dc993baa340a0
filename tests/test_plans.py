"""Physical plans: no Cartesian product, no Python in the plan, broadcast references, pruned scans."""

import pytest

from checks import views
from checks.queries import REGISTRY
from ledgerlens.plans import gold, silver
from ledgerlens.sources.tables import hand_over

BATCH = ("txn_silver", "daily_risk_summary", "daily_anomaly_flags", "daily_fx_exposure", "aml_report", "capital_exposure",
         "txn_audit", "fx_silver", "regulatory_log")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_product_and_no_python(spark, sf_dir, name):
    text = plan(REGISTRY[name](spark, sf_dir))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert banned not in text, banned


def test_enrichment_broadcasts_its_three_references_and_shuffles_no_transaction(spark, sf_dir):
    text = plan(views.txn_silver(spark, sf_dir))
    assert text.count("BroadcastHashJoin") == 3
    assert "SortMergeJoin" not in text


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    return hand_over(views.txn_silver(spark, sf_dir), "txn_silver")


def test_gold_scans_only_what_it_needs(stored):
    text = plan(gold.daily_anomaly_flags(stored))
    schema = text.split("ReadSchema: ")[1]
    assert "merchant_name" not in schema and "ip_address" not in schema
    assert "PushedFilters: [IsNotNull(currency), Not(EqualTo(currency,GBP))]" in plan(
        gold.daily_fx_exposure(stored, views.fx_silver(stored.sparkSession, "/root/testdata/sf0.001"))
    )


def test_several_distinct_counts_expand_the_rollup_and_not_the_rows(stored):
    text = plan(gold.daily_risk_summary(stored))
    assert text.index("Expand") < text.rindex("HashAggregate")  # an aggregate runs below the expansion


def test_high_risk_filter_needs_no_shuffle(stored):
    assert "Exchange" not in plan(silver.high_risk(stored))
