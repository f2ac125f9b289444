"""Plan checks: no Python evaluation, top-k without a sort, filters pushed to the scan."""

import pytest

import __spark_entry__ as entry
from martworks.plans.registry import QUERIES
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_plans(spark, name):
    plan = _plan(entry.queries()[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "PythonUDF" not in plan


def test_top_n_is_take_ordered(spark):
    plan = _plan(entry.queries()["l1_top_n"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in plan


def test_watermark_filter_pushed_to_parquet(spark):
    df = entry.queries()["m6_incremental_load"](spark, SF_SMALL)
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in plan


def test_trim_bounds_pushed_to_parquet(spark):
    plan = _plan(entry.queries()["a7_quantile_trim"](spark, SF_SMALL))
    # the plan string truncates long filter lists; the lower bound shows in PushedFilters
    assert "PushedFilters: [IsNotNull(event_type), IsNotNull(value), EqualTo(event_type,click), GreaterThanOrEqual(value," in plan


def test_scan_prunes_columns(spark):
    plan = _plan(entry.queries()["e3_payment_analysis"](spark, SF_SMALL))
    # payment_id (o_orderkey) is never used by the mart, so it is not read
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string,o_totalprice:double," in plan
