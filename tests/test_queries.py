"""Every registered query runs on the smallest scale factor; the flagship
entry returns rows."""

import warnings

import pytest

import __spark_entry__ as entry

SLOW = {"gbt_scores", "gbt_attribution", "fitted_comparison"}


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "rate" in df.columns


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - SLOW))
def test_query_runs(spark, name):
    warnings.filterwarnings("ignore")
    df = entry.queries()[name](spark, "/root/testdata/sf0.001")
    assert df.count() > 0


def test_every_sql_query_has_spark_twin():
    assert set(entry.oracle_sql()) <= set(entry.queries())
