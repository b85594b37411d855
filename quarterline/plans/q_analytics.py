"""Analytics views: pivot, growth, margins, latest, annual, scoping, series."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterline.functions.metrics import CORE_METRICS
from quarterline.functions.periods import fiscal_label
from quarterline.operators import analytics as A
from quarterline.plans.catalog import SCOPE_MIN_FISCAL_YEAR, Fixtures, register
from quarterline.plans.fixture_sql import pct, with_all

# Measure labels of the metric selector and the margin series.
METRIC_LABELS = {
    "revenue": "Revenue",
    "gross_profit": "Gross Profit",
    "operating_income": "Operating Income",
    "net_income": "Net Income",
}
MARGIN_SERIES = A.MARGIN_SERIES

# ---------------------------------------------------------------- SQL pieces
_WIDE = """SELECT entity_id, fiscal_year, fiscal_period,
  max(CASE WHEN metric = 'revenue' THEN value END) AS revenue,
  max(CASE WHEN metric = 'gross_profit' THEN value END) AS gross_profit,
  max(CASE WHEN metric = 'operating_income' THEN value END) AS operating_income,
  max(CASE WHEN metric = 'net_income' THEN value END) AS net_income
FROM fx_long GROUP BY entity_id, fiscal_year, fiscal_period"""

_QN = "CAST(CASE fiscal_period WHEN 'Q1' THEN 1 WHEN 'Q2' THEN 2 WHEN 'Q3' THEN 3 WHEN 'Q4' THEN 4 END AS INTEGER)"

_LAGGED = f"""SELECT *,
  LAG(revenue, 1) OVER (PARTITION BY entity_id ORDER BY fiscal_year, quarter_number) AS previous_quarter_revenue,
  LAG(revenue, 4) OVER (PARTITION BY entity_id ORDER BY fiscal_year, quarter_number) AS prior_year_quarter_revenue
FROM (SELECT *, {_QN} AS quarter_number FROM w) o"""

_ANALYTICS = f"""SELECT entity_id, fiscal_year, fiscal_period, quarter_number,
  revenue, gross_profit, operating_income, net_income,
  previous_quarter_revenue, prior_year_quarter_revenue,
  revenue - previous_quarter_revenue AS revenue_qoq_change,
  {pct('revenue - previous_quarter_revenue', 'previous_quarter_revenue')} AS revenue_qoq_growth_pct,
  revenue - prior_year_quarter_revenue AS revenue_yoy_change,
  {pct('revenue - prior_year_quarter_revenue', 'prior_year_quarter_revenue')} AS revenue_yoy_growth_pct,
  {pct('gross_profit', 'revenue')} AS gross_margin_pct,
  {pct('operating_income', 'revenue')} AS operating_margin_pct,
  {pct('net_income', 'revenue')} AS net_margin_pct
FROM l"""

_ANNUAL_TOTALS = """SELECT entity_id, fiscal_year,
  CAST(sum(revenue) AS BIGINT) AS revenue, CAST(sum(gross_profit) AS BIGINT) AS gross_profit,
  CAST(sum(operating_income) AS BIGINT) AS operating_income, CAST(sum(net_income) AS BIGINT) AS net_income
FROM w GROUP BY entity_id, fiscal_year"""

_ANNUAL = f"""SELECT entity_id, fiscal_year, revenue, gross_profit, operating_income, net_income,
  prior_year_revenue,
  revenue - prior_year_revenue AS revenue_yoy_change,
  {pct('revenue - prior_year_revenue', 'prior_year_revenue')} AS revenue_yoy_growth_pct,
  {pct('gross_profit', 'revenue')} AS gross_margin_pct,
  {pct('operating_income', 'revenue')} AS operating_margin_pct,
  {pct('net_income', 'revenue')} AS net_margin_pct,
  {pct('operating_income - p_oi', 'p_oi')} AS operating_income_yoy_growth_pct,
  {pct('net_income - p_ni', 'p_ni')} AS net_income_yoy_growth_pct
FROM (SELECT *, LAG(revenue, 1) OVER (PARTITION BY entity_id ORDER BY fiscal_year) AS prior_year_revenue,
             LAG(operating_income, 1) OVER (PARTITION BY entity_id ORDER BY fiscal_year) AS p_oi,
             LAG(net_income, 1) OVER (PARTITION BY entity_id ORDER BY fiscal_year) AS p_ni
      FROM atot) x"""

_COMPLETE = """SELECT entity_id, fiscal_year FROM w GROUP BY entity_id, fiscal_year
HAVING count(DISTINCT fiscal_period) = 4
   AND count(*) FILTER (WHERE fiscal_period NOT IN ('Q1','Q2','Q3','Q4')) = 0
   AND bool_and(revenue IS NOT NULL AND gross_profit IS NOT NULL
                AND operating_income IS NOT NULL AND net_income IS NOT NULL)"""


def _sql(*ctes: tuple[str, str], select: str) -> str:
    return with_all("fx_long", extra=list(ctes)) + "\n" + select


SQL_ANALYTICS = _sql(("w", _WIDE), ("l", _LAGGED), ("qa", _ANALYTICS), select="SELECT * FROM qa")
SQL_ANNUAL = _sql(("w", _WIDE), ("atot", _ANNUAL_TOTALS), ("an", _ANNUAL), select="SELECT * FROM an")


# ---------------------------------------------------------------- builders
def _analytics(fx: Fixtures):
    return A.quarterly_analytics(A.quarterly_wide(fx.long))


def _annual(fx: Fixtures):
    return A.annual_financials(A.annual_totals(A.quarterly_wide(fx.long)))


@register("quarterly_wide", sql=_sql(("w", _WIDE), select="SELECT * FROM w"))
def q_quarterly_wide(spark, sf_dir):
    return A.quarterly_wide(Fixtures(spark, sf_dir).long)


_DASH = f"""SELECT entity_id, fiscal_year, fiscal_period, revenue, gross_profit, operating_income, net_income,
  {pct('gross_profit', 'revenue')} AS gross_margin_pct,
  {pct('operating_income', 'revenue')} AS operating_margin_pct,
  {pct('net_income', 'revenue')} AS net_margin_pct FROM w"""


@register("executive_dashboard", sql=_sql(("w", _WIDE), select=_DASH))
def q_executive_dashboard(spark, sf_dir):
    return A.executive_dashboard(Fixtures(spark, sf_dir).long)


@register("margins", sql=_sql(("w", _WIDE), select=_DASH))
def q_margins(spark, sf_dir):
    return A.with_margins(A.quarterly_wide(Fixtures(spark, sf_dir).long))


@register("quarterly_analytics", sql=SQL_ANALYTICS)
def q_quarterly_analytics(spark, sf_dir):
    return _analytics(Fixtures(spark, sf_dir))


@register("qoq_growth", sql=_sql(("w", _WIDE), ("l", _LAGGED), ("qa", _ANALYTICS), select=(
    "SELECT entity_id, fiscal_year, fiscal_period, revenue, previous_quarter_revenue, revenue_qoq_change, "
    "revenue_qoq_growth_pct FROM qa")))
def q_qoq_growth(spark, sf_dir):
    return _analytics(Fixtures(spark, sf_dir)).select(
        "entity_id", "fiscal_year", "fiscal_period", "revenue", "previous_quarter_revenue",
        "revenue_qoq_change", "revenue_qoq_growth_pct")


@register("yoy_growth", sql=_sql(("w", _WIDE), ("l", _LAGGED), ("qa", _ANALYTICS), select=(
    "SELECT entity_id, fiscal_year, fiscal_period, revenue, prior_year_quarter_revenue, revenue_yoy_change, "
    "revenue_yoy_growth_pct FROM qa")))
def q_yoy_growth(spark, sf_dir):
    return _analytics(Fixtures(spark, sf_dir)).select(
        "entity_id", "fiscal_year", "fiscal_period", "revenue", "prior_year_quarter_revenue",
        "revenue_yoy_change", "revenue_yoy_growth_pct")


@register("latest_quarter", sql=_sql(("w", _WIDE), ("l", _LAGGED), ("qa", _ANALYTICS), select=(
    "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY entity_id "
    "ORDER BY fiscal_year DESC, quarter_number DESC) AS rn FROM qa) WHERE rn = 1")))
def q_latest_quarter(spark, sf_dir):
    return A.latest_quarter(_analytics(Fixtures(spark, sf_dir)))


@register("annual_totals", sql=_sql(("w", _WIDE), select=_ANNUAL_TOTALS))
def q_annual_totals(spark, sf_dir):
    return A.annual_totals(A.quarterly_wide(Fixtures(spark, sf_dir).long))


@register("annual_growth", sql=SQL_ANNUAL)
def q_annual_growth(spark, sf_dir):
    return _annual(Fixtures(spark, sf_dir))


@register("complete_years", sql=_sql(("w", _WIDE), select=_COMPLETE))
def q_complete_years(spark, sf_dir):
    return A.complete_years(A.quarterly_wide(Fixtures(spark, sf_dir).long))


@register("complete_annual", sql=_sql(("w", _WIDE), ("atot", _ANNUAL_TOTALS), ("an", _ANNUAL), ("c", _COMPLETE),
                                      select=f"SELECT * FROM an WHERE (entity_id, fiscal_year) IN "
                                             f"(SELECT (entity_id, fiscal_year) FROM c) "
                                             f"AND fiscal_year >= {SCOPE_MIN_FISCAL_YEAR}"))
def q_complete_annual(spark, sf_dir):
    return A.annual_complete_scoped(A.quarterly_wide(Fixtures(spark, sf_dir).long), SCOPE_MIN_FISCAL_YEAR)


@register("scoped_quarters", sql=_sql(("w", _WIDE), ("l", _LAGGED), ("qa", _ANALYTICS),
                                      select=f"SELECT * FROM qa WHERE fiscal_year >= {SCOPE_MIN_FISCAL_YEAR}"))
def q_scoped_quarters(spark, sf_dir):
    return A.scoped(_analytics(Fixtures(spark, sf_dir)), SCOPE_MIN_FISCAL_YEAR)


@register("last3_years", sql=_sql(("w", _WIDE), select=(
    "SELECT entity_id, fiscal_year, fiscal_period, revenue FROM (SELECT *, dense_rank() OVER "
    "(PARTITION BY entity_id ORDER BY fiscal_year DESC) AS r FROM w) WHERE r <= 3")))
def q_last3_years(spark, sf_dir):
    wide = A.quarterly_wide(Fixtures(spark, sf_dir).long)
    return A.last_n_years(wide, 3).select("entity_id", "fiscal_year", "fiscal_period", "revenue")


_TREND_SQL = _sql(("w", _WIDE), ("l", _LAGGED), ("qa", _ANALYTICS), select=(
    "SELECT entity_id, fiscal_year, fiscal_period, 'FY' || CAST(fiscal_year AS VARCHAR) || ' ' || fiscal_period "
    "AS period_label, revenue / 1e9 AS revenue_billions, fiscal_period = 'Q1' AS is_year_start, "
    "CASE WHEN fiscal_period = 'Q1' THEN 'FY' || CAST(fiscal_year AS VARCHAR) END AS year_tick "
    f"FROM qa WHERE fiscal_year >= {SCOPE_MIN_FISCAL_YEAR} AND revenue IS NOT NULL"))


@register("trend_revenue", sql=_TREND_SQL)
def q_trend_revenue(spark, sf_dir):
    """Labelled revenue series in billions, Q1 rows marked."""
    qa = A.scoped(_analytics(Fixtures(spark, sf_dir)), SCOPE_MIN_FISCAL_YEAR).dropna(subset=["revenue"])
    return qa.select(
        "entity_id", "fiscal_year", "fiscal_period",
        fiscal_label("fiscal_year", "fiscal_period").alias("period_label"),
        (F.col("revenue") / F.lit(1e9)).alias("revenue_billions"),
        (F.col("fiscal_period") == "Q1").alias("is_year_start"),
        F.when(F.col("fiscal_period") == "Q1", fiscal_label("fiscal_year")).alias("year_tick"),
    )


_METRIC_LABEL_CASE = "CASE metric " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in METRIC_LABELS.items()) + " END"


@register("trend_metric_long", sql=_sql(("w", _WIDE), select=(
    f"SELECT entity_id, fiscal_year, fiscal_period, metric, {_METRIC_LABEL_CASE} AS metric_label, "
    "value / 1e9 AS value_billions FROM (UNPIVOT (SELECT entity_id, fiscal_year, fiscal_period, revenue, "
    "gross_profit, operating_income, net_income FROM w) ON revenue, gross_profit, operating_income, net_income "
    f"INTO NAME metric VALUE value) WHERE fiscal_year >= {SCOPE_MIN_FISCAL_YEAR} AND value IS NOT NULL")))
def q_trend_metric_long(spark, sf_dir):
    """The four measures as one long series table, filtered per selection."""
    wide = A.scoped(A.quarterly_wide(Fixtures(spark, sf_dir).long), SCOPE_MIN_FISCAL_YEAR)
    long = wide.unpivot(["entity_id", "fiscal_year", "fiscal_period"], CORE_METRICS, "metric", "value")
    label = F.create_map(*[x for k, v in METRIC_LABELS.items() for x in (F.lit(k), F.lit(v))])
    return long.where(F.col("value").isNotNull()).select(
        "entity_id", "fiscal_year", "fiscal_period", "metric",
        F.element_at(label, F.col("metric")).alias("metric_label"),
        (F.col("value") / F.lit(1e9)).alias("value_billions"),
    )


_MS_UNION = " UNION ALL ".join(
    f"SELECT entity_id, fiscal_year, fiscal_period, '{v}' AS series, {k} AS value FROM qa" for k, v in MARGIN_SERIES.items())


@register("margin_series", sql=_sql(("w", _WIDE), ("l", _LAGGED), ("qa", _ANALYTICS), select=(
    "SELECT entity_id, fiscal_year, fiscal_period, 'FY' || CAST(fiscal_year AS VARCHAR) || ' ' || fiscal_period "
    f"AS period_label, series, value FROM ({_MS_UNION}) u WHERE fiscal_year >= {SCOPE_MIN_FISCAL_YEAR}")))
def q_margin_series(spark, sf_dir):
    """Three margins as (series, value) rows for one chart."""
    qa = A.scoped(_analytics(Fixtures(spark, sf_dir)), SCOPE_MIN_FISCAL_YEAR)
    return A.margin_series(qa, ["entity_id", "fiscal_year", "fiscal_period"], fiscal_label("fiscal_year", "fiscal_period"))


_ANNUAL_MS = " UNION ALL ".join(
    f"SELECT entity_id, fiscal_year, 'FY' || CAST(fiscal_year AS VARCHAR) AS period_label, '{v}' AS series, {k} AS value FROM an"
    for k, v in MARGIN_SERIES.items())


@register("annual_margin_series", sql=_sql(("w", _WIDE), ("atot", _ANNUAL_TOTALS), ("an", _ANNUAL), select=_ANNUAL_MS))
def q_annual_margin_series(spark, sf_dir):
    """Three annual margins as (series, value) rows for one chart."""
    annual = A.annual_financials(A.annual_totals(A.quarterly_wide(Fixtures(spark, sf_dir).long)))
    return A.margin_series(annual, ["entity_id", "fiscal_year"], fiscal_label("fiscal_year"))


def _export_sql() -> str:
    from quarterline.sources.exports import ONE_PER_ENTITY

    views = {"latest_quarter": "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY "
                               "fiscal_year DESC, quarter_number DESC) AS rn FROM qa) WHERE rn = 1)",
             "quarterly_analytics": "qa", "annual_financials": "an", "quarterly_financials": "w"}
    parts = []
    for name, src in views.items():
        rule = "max(n) = 1" if name in ONE_PER_ENTITY else "true"
        parts.append(
            f"SELECT '{name}' AS export_name, '' AS missing_columns, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows, "
            f"count(*) AS entities, CAST(coalesce(max(n), 0) AS BIGINT) AS max_rows_per_entity, "
            f"CAST(coalesce(sum(s), 0) AS BIGINT) AS scoped_rows, {rule} AS row_rule_ok, "
            f"coalesce(sum(n), 0) > 0 AND {rule} AND coalesce(sum(s), 0) > 0 AS ok "
            f"FROM (SELECT entity_id, count(*) AS n, sum(CASE WHEN fiscal_year >= {SCOPE_MIN_FISCAL_YEAR} THEN 1 "
            f"ELSE 0 END) AS s FROM {src} x GROUP BY entity_id) e")
    return _sql(("w", _WIDE), ("l", _LAGGED), ("qa", _ANALYTICS), ("atot", _ANNUAL_TOTALS), ("an", _ANNUAL),
                select=" UNION ALL ".join(parts))


@register("export_contract_report", sql=_export_sql())
def q_export_contract_report(spark, sf_dir):
    """Required columns, row counts, one latest row per entity, scoped rows."""
    from quarterline.sources.exports import contract_report

    wide = A.quarterly_wide(Fixtures(spark, sf_dir).long)
    qa = A.quarterly_analytics(wide)
    frames = {"latest_quarter": A.latest_quarter(qa), "quarterly_analytics": qa,
              "annual_financials": A.annual_financials(A.annual_totals(wide)), "quarterly_financials": wide}
    return contract_report(frames, SCOPE_MIN_FISCAL_YEAR)
