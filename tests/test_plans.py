"""Plan shape guards: the properties the scale design relies on."""

import pytest

from tests.conftest import SF_SMOKE
from tools.plan_report import HEADLINE, plan_text, summarize
from vitrina.plans.registry import QUERIES


@pytest.fixture(scope="module")
def plans(spark):
    return {k: plan_text(QUERIES[k](spark, SF_SMOKE)) for k in HEADLINE}


def test_no_nested_loop_joins(plans):
    for k, text in plans.items():
        assert "NestedLoopJoin" not in text, k
        assert "CartesianProduct" not in text, k


@pytest.mark.parametrize("key", ["payment_summary", "payment_summary_v2"])
def test_summaries_read_the_shared_aggregate_only(plans, key):
    scans = [t for t, _, _ in summarize(plans[key])["scans"]]
    assert scans and all(t.startswith("accounts/") for t in scans), scans


def test_budget_carry_reads_materialized_rows(plans):
    scans = [t for t, _, _ in summarize(plans["budget_integrations"])["scans"]]
    assert scans and all(t.startswith("stage/") for t in scans), scans


def test_fact_scans_are_pruned(plans):
    for k, text in plans.items():
        for table, _, schema in summarize(text)["scans"]:
            if table.endswith("lineitem.parquet"):
                assert "l_discount" not in schema and "l_tax" not in schema, (k, schema)


def test_no_shuffle_on_hot_keys(spark):
    """With hardly any automatic broadcast the sheets are still not dealt by month alone, nor the
    posts by (grade, currency) alone."""
    import re
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        texts = [plan_text(QUERIES[k](spark, SF_SMOKE)) for k in ("budget_clean", "bracket_join_row", "bracket_join_agg")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for text in texts:
        for keys in re.findall(r"hashpartitioning\(([^)]*)\)", text):
            names = set(re.findall(r"([A-Za-z_]+)#", keys))
            assert names and names not in ({"sheets_name"}, {"grade", "currency"}), keys
