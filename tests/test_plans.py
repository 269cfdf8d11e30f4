"""Physical-plan properties the scale design relies on."""
import pytest

import __spark_entry__ as E
from keelson.plans.queries import QUERIES as CORE

from conftest import SF_SMALL

BATCH = [n for n in sorted(CORE) if not n.startswith("stream_")
         and n not in ("table_overwrite_roundtrip", "incremental_upsert", "stage_row_counts")]


def plan(spark, name):
    return E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


def test_each_message_parsed_once(spark):
    p = plan(spark, "cdc_parse_envelope")
    assert p.count("from_json(") == 1


@pytest.mark.parametrize("name", ["cdc_parse_envelope", "quality_split_quarantine", "fact_ledger", "end_to_end_star", "cdc_current_state_deletes"])
def test_each_decimal_decoded_once(spark, name):
    p = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("unbase64(") == 1 and p.count("from_json(") == 1


def test_before_and_after_decimals_decoded_once_each(spark):
    p = E.queries()["cdc_change_diff"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("unbase64(") == 2 and p.count("from_json(") == 1


def test_current_state_is_partially_aggregated(spark):
    p = plan(spark, "cdc_current_state_agg")
    assert "partial_max_by" in p


def test_row_number_form_limits_before_shuffle(spark):
    p = plan(spark, "cdc_current_state")
    assert "WindowGroupLimit" in p


def test_filters_reach_the_scan(spark):
    p = plan(spark, "refund_candidates")
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,P)" in p


def test_projection_is_pruned(spark):
    p = plan(spark, "rule_implication")
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_orderpriority:string>" in p


@pytest.mark.parametrize("name", BATCH)
def test_no_cartesian_products(spark, name):
    p = plan(spark, name)
    assert "CartesianProduct" not in p
    if "BroadcastNestedLoopJoin" in p:          # only the size-checked band join
        assert name in ("tier_assignment", "tier_distribution")


@pytest.mark.parametrize("name", BATCH)
def test_no_python_udfs(spark, name):
    p = plan(spark, name)
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
        assert node not in p
