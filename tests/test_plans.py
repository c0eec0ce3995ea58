"""Physical-plan properties of the registered queries (scale guards)."""

import warnings

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
SLOW = {"gbt_scores", "gbt_attribution", "backtest", "lr_scores", "roundtrip", "stream_scores",
        "calibration_points"}
SUBSTRING = {"feature_frame", "op_city_lookup", "clean_union", "tree_prep", "category_profile",
             "feature_drift", "drift_summary", "target_encode", "target_encode_oof", "one_hot_long",
             "linear_importance", "routed_decision",
             "backtest_target_maps"}  # range join against the bounded period table


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - SLOW))
def test_no_cartesian_and_theta_joins_only_for_substring(spark, name):
    warnings.filterwarnings("ignore")
    p = plan_of(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in p
    if "BroadcastNestedLoopJoin" in p:
        assert name in SUBSTRING, name


def test_column_pruning_reaches_scans(spark):
    p = plan_of(entry.queries()["doc_quality_metrics"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,n_chars:bigint>" in p
    assert "text" not in p.split("documents.parquet")[0][-300:]


def test_leads_view_prunes_lineitem_and_part(spark):
    from orderlens.sources.leads import leads_view
    p = plan_of(leads_view(spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in p
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in p
