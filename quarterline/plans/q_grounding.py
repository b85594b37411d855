"""Grounding queries: eligibility, calendar neighbours, as-of annual, figures."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterline.operators import analytics as A
from quarterline.operators import grounding as G
from quarterline.plans import q_analytics as QA
from quarterline.plans.catalog import SCOPE_MIN_FISCAL_YEAR, Fixtures, register
from quarterline.plans.fixture_sql import with_all

_CORE_OK = " AND ".join(f"{m} IS NOT NULL" for m in ("revenue", "gross_profit", "operating_income", "net_income"))


def _cols(prefix: str, alias: str, metrics: list[str]) -> str:
    return ", ".join([f"{alias}.fiscal_year AS {prefix}_fy", f"{alias}.fiscal_period AS {prefix}_fp"]
                     + [f"CAST({alias}.{m} AS DECIMAL(38,6)) AS {prefix}_{m}" for m in metrics])


_ANN_COLS = ", ".join(["fiscal_year AS an_fy"] + [f"CAST({m} AS DECIMAL(38,6)) AS an_{m}" for m in G.ANNUAL_METRICS])

_CTES = [
    ("w", QA._WIDE), ("l", QA._LAGGED), ("qa", QA._ANALYTICS), ("atot", QA._ANNUAL_TOTALS), ("an", QA._ANNUAL),
    ("c", QA._COMPLETE),
    ("sq", f"SELECT * FROM qa WHERE fiscal_year >= {SCOPE_MIN_FISCAL_YEAR}"),
    ("sa", f"SELECT * FROM an WHERE (entity_id, fiscal_year) IN (SELECT (entity_id, fiscal_year) FROM c) "
           f"AND fiscal_year >= {SCOPE_MIN_FISCAL_YEAR}"),
    ("el", f"SELECT * EXCLUDE (n), fiscal_year * 4 + quarter_number AS period_index FROM "
           f"(SELECT *, count(*) OVER (PARTITION BY entity_id, fiscal_year, fiscal_period) AS n FROM sq) x "
           f"WHERE n = 1 AND {_CORE_OK}"),
    ("ak", f"SELECT entity_id, fiscal_year * 4 + 4 AS k, {_ANN_COLS} FROM sa WHERE {_CORE_OK}"),
    ("nb", f"SELECT e.*, {_cols('pv', 'p', G.COMPARISON_METRICS)}, {_cols('py', 'y', G.COMPARISON_METRICS)} "
           f"FROM el e LEFT JOIN el p ON p.entity_id = e.entity_id AND p.period_index = e.period_index - 1 "
           f"LEFT JOIN el y ON y.entity_id = e.entity_id AND y.period_index = e.period_index - 4"),
    ("ctx", "SELECT n.*, a.* EXCLUDE (entity_id, k) FROM nb n ASOF LEFT JOIN ak a "
            "ON n.entity_id = a.entity_id AND n.period_index >= a.k"),
]


def _pid(fy: str, fp: str) -> str:
    return f"('FY' || CAST({fy} AS VARCHAR) || '-' || {fp})"


def _fig_selects() -> str:
    parts = []
    for m in G.PERIOD_METRICS:
        unit = "percent" if m in G.PERCENT_METRICS else "usd"
        pid = _pid("fiscal_year", "fiscal_period")
        parts.append(f"SELECT entity_id, fiscal_year, fiscal_period, 'current' AS role, {pid} AS period_id, "
                     f"'quarterly_analytics:' || {pid} AS source_id, '{m}' AS metric, '{unit}' AS unit, "
                     f"CAST({m} AS DECIMAL(38,6)) AS value FROM ctx")
    for role, px in (("previous", "pv"), ("prior_year", "py")):
        for m in G.COMPARISON_METRICS:
            unit = "percent" if m in G.PERCENT_METRICS else "usd"
            pid = _pid(f"{px}_fy", f"{px}_fp")
            parts.append(f"SELECT entity_id, fiscal_year, fiscal_period, '{role}', {pid}, "
                         f"'quarterly_analytics:' || {pid}, '{m}', '{unit}', {px}_{m} FROM ctx "
                         f"WHERE {px}_fy IS NOT NULL")
    for m in G.ANNUAL_METRICS:
        unit = "percent" if m in G.PERCENT_METRICS else "usd"
        parts.append(f"SELECT entity_id, fiscal_year, fiscal_period, 'annual', 'FY' || CAST(an_fy AS VARCHAR), "
                     f"'annual_financials:FY' || CAST(an_fy AS VARCHAR), '{m}', '{unit}', an_{m} FROM ctx "
                     f"WHERE an_fy IS NOT NULL")
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") u WHERE value IS NOT NULL"


GROUNDING_CTES = _CTES + [("gf", _fig_selects())]


def _sql(select: str) -> str:
    return with_all("fx_long", extra=GROUNDING_CTES) + "\n" + select


def scoped_inputs(fx: Fixtures):
    wide = A.quarterly_wide(fx.long)
    analytics = A.scoped(A.quarterly_analytics(wide), SCOPE_MIN_FISCAL_YEAR)
    annual = A.annual_complete_scoped(wide, SCOPE_MIN_FISCAL_YEAR)
    return analytics, annual


def contexts(fx: Fixtures):
    analytics, annual = scoped_inputs(fx)
    return G.grounding_contexts(analytics, annual)


@register("eligible_periods", sql=_sql("SELECT entity_id, fiscal_year, fiscal_period, period_index FROM el"))
def q_eligible_periods(spark, sf_dir):
    """Periods that can be grounded (unique key, core metrics present)."""
    analytics, _ = scoped_inputs(Fixtures(spark, sf_dir))
    return G.eligible_periods(analytics).select("entity_id", "fiscal_year", "fiscal_period", "period_index")


_PREV_ID = ("'FY' || CAST((period_index - 2) // 4 AS VARCHAR) || '-Q' || "
            "CAST(period_index - 2 - ((period_index - 2) // 4) * 4 + 1 AS VARCHAR)")
_PRIOR_ID = ("'FY' || CAST((period_index - 5) // 4 AS VARCHAR) || '-Q' || "
             "CAST(period_index - 5 - ((period_index - 5) // 4) * 4 + 1 AS VARCHAR)")


@register("period_neighbors", sql=_sql(
    f"SELECT entity_id, fiscal_year, fiscal_period, {_PREV_ID} AS previous_period_id, pv_fy IS NOT NULL AS "
    f"previous_available, CAST(pv_revenue AS BIGINT) AS previous_revenue, {_PRIOR_ID} AS prior_year_period_id, "
    f"py_fy IS NOT NULL AS prior_year_available, CAST(py_revenue AS BIGINT) AS prior_year_revenue FROM nb"))
def q_period_neighbors(spark, sf_dir):
    """Previous and prior-year quarter by calendar key."""
    analytics, _ = scoped_inputs(Fixtures(spark, sf_dir))
    nb = G.with_neighbors(G.eligible_periods(analytics))
    return nb.select(
        "entity_id", "fiscal_year", "fiscal_period",
        G.neighbor_keys(F.col("period_index"), 1).alias("previous_period_id"),
        F.col("previous").isNotNull().alias("previous_available"),
        F.col("previous.revenue").cast("bigint").alias("previous_revenue"),
        G.neighbor_keys(F.col("period_index"), 4).alias("prior_year_period_id"),
        F.col("prior_year").isNotNull().alias("prior_year_available"),
        F.col("prior_year.revenue").cast("bigint").alias("prior_year_revenue"),
    )


@register("asof_annual", sql=_sql(
    "SELECT entity_id, fiscal_year, fiscal_period, an_fy AS annual_fiscal_year, CAST(an_revenue AS BIGINT) AS annual_revenue, "
    "CAST(an_net_income AS BIGINT) AS annual_net_income, "
    "CAST(an_revenue_yoy_growth_pct AS DOUBLE) AS annual_revenue_yoy_growth_pct FROM ctx"))
def q_asof_annual(spark, sf_dir):
    """Latest complete year known as of each quarter (no look-ahead)."""
    ctx = contexts(Fixtures(spark, sf_dir))
    return ctx.select("entity_id", "fiscal_year", "fiscal_period",
                      F.col("annual.fiscal_year").alias("annual_fiscal_year"),
                      F.col("annual.revenue").cast("bigint").alias("annual_revenue"),
                      F.col("annual.net_income").cast("bigint").alias("annual_net_income"),
                      F.col("annual.revenue_yoy_growth_pct").cast("double").alias("annual_revenue_yoy_growth_pct"))


@register("grounded_figures", sql=_sql("SELECT * REPLACE (CAST(value AS VARCHAR) AS value) FROM gf"))
def q_grounded_figures(spark, sf_dir):
    """Every grounded figure of every eligible period, long form; values as exact decimal text."""
    g = G.grounded_figures(contexts(Fixtures(spark, sf_dir)))
    return g.withColumn("value", F.col("value").cast("string"))


# the grounded figures with one rule broken by key (unit, whole dollars, source, repeated metric)
_BROKEN = """SELECT g.* REPLACE (
    CASE WHEN k = 3 AND metric = 'net_income' THEN 'other:' || period_id ELSE source_id END AS source_id,
    CASE WHEN k = 1 AND metric = 'net_income' THEN 'percent' ELSE unit END AS unit,
    CASE WHEN k = 2 AND metric = 'revenue' THEN value + 0.5 ELSE value END AS value)
  FROM (SELECT *, (entity_id * 3 + fiscal_year) % 7 AS k FROM gf) g
  JOIN (VALUES (0), (1)) c(copy) ON copy = 0 OR (k = 4 AND metric = 'revenue')"""


@register("grounded_figure_rules", sql=_sql(f"""
SELECT entity_id, fiscal_year, fiscal_period, role, count(*) AS figures, count(DISTINCT metric) AS distinct_metrics,
  count(DISTINCT source_id) AS sources,
  CAST(sum(CASE WHEN unit <> CASE WHEN metric IN ('revenue_qoq_growth_pct', 'revenue_yoy_growth_pct',
      'gross_margin_pct', 'operating_margin_pct', 'net_margin_pct') THEN 'percent' ELSE 'usd' END THEN 1 ELSE 0 END)
      AS BIGINT) AS bad_units,
  CAST(sum(CASE WHEN unit = 'usd' AND value <> floor(value) THEN 1 ELSE 0 END) AS BIGINT) AS non_integral,
  CAST(sum(CASE WHEN source_id <> CASE WHEN role = 'annual' THEN 'annual_financials' ELSE 'quarterly_analytics' END
      || ':' || period_id THEN 1 ELSE 0 END) AS BIGINT) AS bad_source_ids,
  CAST(sum(CASE WHEN unit <> CASE WHEN metric IN ('revenue_qoq_growth_pct', 'revenue_yoy_growth_pct',
      'gross_margin_pct', 'operating_margin_pct', 'net_margin_pct') THEN 'percent' ELSE 'usd' END THEN 1 ELSE 0 END)
    + sum(CASE WHEN unit = 'usd' AND value <> floor(value) THEN 1 ELSE 0 END)
    + sum(CASE WHEN source_id <> CASE WHEN role = 'annual' THEN 'annual_financials' ELSE 'quarterly_analytics' END
      || ':' || period_id THEN 1 ELSE 0 END)
    + count(*) - count(DISTINCT metric) + count(DISTINCT source_id) - 1 AS BIGINT) AS violations
FROM ({_BROKEN}) gf GROUP BY entity_id, fiscal_year, fiscal_period, role"""))
def q_grounded_figure_rules(spark, sf_dir):
    """Grounded-figure invariants per period and role."""
    f = G.grounded_figures(contexts(Fixtures(spark, sf_dir)))
    rule = (F.col("entity_id") * 3 + F.col("fiscal_year")) % 7
    income, revenue = F.col("metric") == "net_income", F.col("metric") == "revenue"
    f = f.select(
        "entity_id", "fiscal_year", "fiscal_period", "role", "period_id",
        F.when((rule == 3) & income, F.concat(F.lit("other:"), F.col("period_id"))).otherwise(F.col("source_id")).alias("source_id"),
        "metric", F.when((rule == 1) & income, "percent").otherwise(F.col("unit")).alias("unit"),
        F.when((rule == 2) & revenue, F.col("value") + F.lit("0.5").cast("decimal(38,6)")).otherwise(F.col("value")).alias("value"),
        F.explode(F.when((rule == 4) & revenue, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return G.figure_rules(f.drop("copy"))


def _json_figures(metrics: list[str], prefix: str, sid: str) -> str:
    """DuckDB text of a figure list, NULL values left out."""
    items = []
    for m in metrics:
        value = f"regexp_replace(regexp_replace(CAST(CAST({prefix}{m} AS DECIMAL(38,6)) AS VARCHAR), '0+$', ''), '[.]$', '')"
        unit = "percent" if m in G.PERCENT_METRICS else "usd"
        items.append(f"CASE WHEN {prefix}{m} IS NOT NULL THEN '{{\"metric\":\"{m}\",\"source_id\":\"' || {sid} || "
                     f"'\",\"unit\":\"{unit}\",\"value\":\"' || {value} || '\"}}' END")
    return f"'[' || concat_ws(',', {', '.join(items)}) || ']'"


def _json_period(fy: str, fp: str) -> str:
    return f"'{{\"fiscal_period\":\"' || {fp} || '\",\"fiscal_year\":' || CAST({fy} AS VARCHAR) || '}}'"


def _json_quarter(metrics: list[str], prefix: str, fy: str, fp: str) -> str:
    sid = f"('quarterly_analytics:' || {_pid(fy, fp)})"
    return (f"'{{\"figures\":' || {_json_figures(metrics, prefix, sid)} || ',\"period\":' || {_json_period(fy, fp)} || "
            f"',\"source_id\":\"' || {sid} || '\"}}'")


def _json_source(dataset: str, pid: str) -> str:
    return f"'{{\"dataset\":\"{dataset}\",\"period_id\":\"' || {pid} || '\",\"source_id\":\"{dataset}:' || {pid} || '\"}}'"


_AN_SID = "('annual_financials:FY' || CAST(an_fy AS VARCHAR))"
_PROMPT = (
    "SELECT entity_id, fiscal_year, fiscal_period, '{\"annual_context\":' || CASE WHEN an_fy IS NULL THEN 'null' ELSE "
    f"'{{\"figures\":' || {_json_figures(G.ANNUAL_METRICS, 'an_', _AN_SID)} || ',\"fiscal_year\":' || CAST(an_fy AS VARCHAR) || "
    f"',\"source_id\":\"' || {_AN_SID} || '\"}}' END || ',\"current_period\":' || "
    f"{_json_quarter(G.PERIOD_METRICS, '', 'fiscal_year', 'fiscal_period')} || ',\"entity\":\"Entity ' || CAST(entity_id AS VARCHAR) || "
    f"'\",\"previous_quarter\":' || CASE WHEN pv_fy IS NULL THEN 'null' ELSE {_json_quarter(G.COMPARISON_METRICS, 'pv_', 'pv_fy', 'pv_fp')} END || "
    f"',\"prior_year_quarter\":' || CASE WHEN py_fy IS NULL THEN 'null' ELSE {_json_quarter(G.COMPARISON_METRICS, 'py_', 'py_fy', 'py_fp')} END || "
    f"',\"requested_period\":' || {_json_period('fiscal_year', 'fiscal_period')} || ',\"schema_version\":\"1.0\",\"sources\":[' || concat_ws(',', "
    f"{_json_source('quarterly_analytics', _pid('fiscal_year', 'fiscal_period'))}, "
    f"CASE WHEN pv_fy IS NOT NULL THEN {_json_source('quarterly_analytics', _pid('pv_fy', 'pv_fp'))} END, "
    f"CASE WHEN py_fy IS NOT NULL THEN {_json_source('quarterly_analytics', _pid('py_fy', 'py_fp'))} END, "
    f"CASE WHEN an_fy IS NOT NULL THEN {_json_source('annual_financials', chr(40) + chr(39) + 'FY' + chr(39) + ' || CAST(an_fy AS VARCHAR))')} END"
    ") || ']}' AS context_json FROM ctx")


@register("prompt_corpus", sql=_sql(_PROMPT))
def q_prompt_corpus(spark, sf_dir):
    """H9: deterministic, alphabetically keyed context JSON per eligible period."""
    return G.prompt_context_json(contexts(Fixtures(spark, sf_dir)))
