"""A sample of registered queries against their DuckDB oracle at sf0.001
(tools/compare.py runs all of them)."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E

from conftest import SMALL

SAMPLE = ["quarterly_analytics", "annual_growth", "complete_annual", "derive_q4", "q4_underivable",
          "dq_missing_periods", "segment_reconcile", "segment_contribution", "asof_annual", "grounded_figures",
          "margin_direction", "glossary_match", "advice_filter", "briefing_errors", "response_acceptance", "answer_errors",
          "qa_prompts", "facts_scan_report"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return int(v) if v == v.to_integral_value() else str(v.normalize())
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("supplier", "part", "lineitem", "conversations", "documents"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SMALL)
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(ocols, cur.fetchall())
