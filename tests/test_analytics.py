"""Quarterly / annual analytics, checked against the reference's published latest quarter."""

from pyspark.sql import functions as F

from quarterline.operators import analytics as A

# Published FY2026 Q4 figures (revenue, gross, operating, net) and the
# two comparison revenues that produce the published growth rates.
LATEST = (2026, "Q4", 90007000000, 60482000000, 40603000000, 35766000000)
PREVIOUS_REVENUE = 82886000000
PRIOR_YEAR_REVENUE = 76441000000


def _long(spark, rows):
    out = []
    for fy, fp, rev, gp, oi, ni in rows:
        for m, v in (("revenue", rev), ("gross_profit", gp), ("operating_income", oi), ("net_income", ni)):
            out.append((7, m, fy, fp, v))
    return spark.createDataFrame(out, "entity_id bigint, metric string, fiscal_year int, fiscal_period string, "
                                      "value bigint")


def test_latest_quarter_matches_published_values(spark):
    rows = [(2025, "Q4", PRIOR_YEAR_REVENUE, 1, 1, 1), (2026, "Q1", 70000000000, 1, 1, 1),
            (2026, "Q2", 80000000000, 1, 1, 1), (2026, "Q3", PREVIOUS_REVENUE, 1, 1, 1), LATEST]
    qa = A.quarterly_analytics(A.quarterly_wide(_long(spark, rows)))
    r = A.latest_quarter(qa).collect()[0]
    assert (r.fiscal_year, r.fiscal_period, r.quarter_number) == (2026, "Q4", 4)
    assert r.revenue_qoq_change == 7121000000 and r.revenue_yoy_change == 13566000000
    assert (r.revenue_qoq_growth_pct, r.revenue_yoy_growth_pct) == (8.59, 17.75)
    assert (r.gross_margin_pct, r.operating_margin_pct, r.net_margin_pct) == (67.2, 45.11, 39.74)


def test_lag_is_positional_not_calendar(spark):
    # FY2012 Q2 is missing: LAG(4) from FY2013 Q2 lands on FY2012 Q1, as in the view
    rows = [(2012, "Q1", 100, 1, 1, 1), (2012, "Q3", 300, 1, 1, 1), (2012, "Q4", 400, 1, 1, 1),
            (2013, "Q1", 500, 1, 1, 1), (2013, "Q2", 600, 1, 1, 1)]
    qa = A.quarterly_analytics(A.quarterly_wide(_long(spark, rows)))
    r = qa.where((F.col("fiscal_year") == 2013) & (F.col("fiscal_period") == "Q2")).collect()[0]
    assert r.prior_year_quarter_revenue == 100 and r.previous_quarter_revenue == 500


def test_zero_denominator_is_null_and_annual_sums_partial_years(spark):
    rows = [(2020, "Q3", 0, 5, 5, 5), (2020, "Q4", 10, 5, 5, -5), (2021, "Q1", 20, 5, 5, 5)]
    wide = A.quarterly_wide(_long(spark, rows))
    qa = A.quarterly_analytics(wide).orderBy("fiscal_year", "quarter_number").collect()
    assert qa[0].gross_margin_pct is None and qa[1].revenue_qoq_growth_pct is None
    annual = {r.fiscal_year: r for r in A.annual_totals(wide).collect()}
    assert annual[2020].revenue == 10 and annual[2020].net_income == 0
    assert A.complete_years(wide).count() == 0


def test_year_floor_applies_after_window(spark):
    rows = [(2018, "Q4", 100, 1, 1, 1), (2019, "Q1", 150, 1, 1, 1)]
    qa = A.scoped(A.quarterly_analytics(A.quarterly_wide(_long(spark, rows))), 2019).collect()
    assert len(qa) == 1 and qa[0].previous_quarter_revenue == 100 and qa[0].revenue_qoq_growth_pct == 50.0
