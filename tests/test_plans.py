"""Plan shape: no single-partition exchange, no Python UDF, pruned scans."""

import pytest

import __spark_entry__ as E

from conftest import SMALL

CHECKED = ["quarterly_analytics", "latest_quarter", "annual_growth", "derive_q4", "segment_contribution",
           "asof_annual", "grounded_figures", "dq_summary", "question_route", "margin_direction"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", CHECKED)
def test_no_single_partition_and_no_python(spark, name):
    plan = _plan(E.queries()[name](spark, SMALL))
    assert "SinglePartition" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "PythonUDF" not in plan


def test_scan_reads_only_needed_columns(spark):
    df = E.queries()["quarterly_analytics"](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "l_orderkey" not in plan and "l_quantity" not in plan and "l_linestatus" not in plan


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "revenue_yoy_growth_pct" in df.columns


def test_bucketed_facts_table_needs_no_shuffle(spark):
    from quarterline.operators import analytics as A
    from quarterline.operators import quality as Q
    from quarterline.plans.catalog import Fixtures

    long = Fixtures(spark, SMALL).long.drop("q")
    import uuid

    table = Q.save_bucketed(long, f"quarterline_facts_{uuid.uuid4().hex[:8]}", buckets=4)
    qa = A.quarterly_analytics(A.quarterly_wide(table))
    plan = _plan(qa)
    assert "Exchange" not in plan, plan
    assert qa.count() == A.quarterly_analytics(A.quarterly_wide(long)).count()
