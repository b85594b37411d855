"""Narrative queries: KPI text, margin direction, insights, plain English, drivers."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterline.functions.arrays import each
from quarterline.operators import analytics as A
from quarterline.operators import drivers as D
from quarterline.operators import knowledge as KN
from quarterline.operators import narrative as N
from quarterline.plans import q_claims as QC
from quarterline.plans import q_drivers as QD
from quarterline.plans import q_grounding as QG
from quarterline.plans.catalog import SCOPE_MIN_FISCAL_YEAR, Fixtures, register
from quarterline.plans.fixture_sql import with_all

K = "entity_id, fiscal_year, fiscal_period"

_RANK = f"""SELECT {K}, direction, segment, absolute_revenue_change, contribution_pct,
  row_number() OVER (PARTITION BY {K}, direction ORDER BY CASE WHEN direction = 'positive'
    THEN -absolute_revenue_change ELSE absolute_revenue_change END, segment) AS rank
FROM (SELECT *, CASE WHEN absolute_revenue_change > 0 THEN 'positive' ELSE 'negative' END AS direction
      FROM contrib WHERE absolute_revenue_change <> 0) x"""
_NEG = " OR ".join(f"metric = '{m}'" for m in N.NEGATIVE_SIGNAL_METRICS)
_POS = " OR ".join(f"metric = '{m}'" for m in N.POSITIVE_SIGNAL_METRICS)
_DRIVERS = f"""SELECT v.entity_id, v.fiscal_year, v.fiscal_period, rk.pos1, rk.pos2, rk.neg1, sig.pos_signal,
  sig.neg_signal, ex.context_statement
FROM (SELECT {K} FROM recon WHERE valid) v
LEFT JOIN (SELECT {K}, max(CASE WHEN direction = 'positive' AND rank = 1 THEN segment END) AS pos1,
                  max(CASE WHEN direction = 'positive' AND rank = 2 THEN segment END) AS pos2,
                  max(CASE WHEN direction = 'negative' AND rank = 1 THEN segment END) AS neg1
           FROM rnk GROUP BY ALL) rk USING ({K})
LEFT JOIN (SELECT {K}, max(CASE WHEN ({_POS}) AND value > 0 THEN split_part(label, ' growth', 1) END) AS pos_signal,
                  string_agg(CASE WHEN ({_NEG}) AND value < 0 THEN split_part(label, ' growth', 1) END, ' and ')
                    AS neg_signal
           FROM (SELECT {K}, metric, arg_max(label, pos) AS label, arg_max(value, pos) AS value FROM pk_facts
                 WHERE kind = 'product_indicator' GROUP BY ALL) il GROUP BY ALL) sig USING ({K})
LEFT JOIN (SELECT {K}, first(statement) AS context_statement FROM pk_explanations
           WHERE explanation_id = '{N.CONTEXT_EXPLANATION_ID}' GROUP BY ALL) ex USING ({K})"""
_X = f"""SELECT e.entity_id, e.fiscal_year, e.fiscal_period, e.revenue_qoq_growth_pct AS qoq,
  e.revenue_yoy_growth_pct AS yoy, e.net_margin_pct, d.*  EXCLUDE (entity_id, fiscal_year, fiscal_period),
  d.entity_id IS NOT NULL AS has,
  coalesce(e.revenue_qoq_growth_pct > 0 AND e.revenue_yoy_growth_pct > 0, false) AS strong,
  coalesce(e.revenue_qoq_growth_pct > 0, false) OR coalesce(e.revenue_yoy_growth_pct > 0, false) AS some_up
FROM el e LEFT JOIN drv d USING ({K})"""
_NAME = "'Entity ' || CAST(entity_id AS VARCHAR)"
_HEAD = (f"CASE WHEN strong THEN {_NAME} || ' had a strong quarter.' WHEN some_up THEN {_NAME} || "
         f"' reported positive revenue momentum.' ELSE {_NAME} || '’s latest quarter requires a closer look.' END")
_MOM = (f"CASE WHEN strong THEN '{N.STRONG_MOMENTUM}' WHEN some_up THEN 'Revenue increased compared with the ' || "
        f"CASE WHEN coalesce(qoq > 0, false) THEN 'prior quarter' ELSE 'same quarter last year' END || '.' "
        f"ELSE '{N.WEAK_MOMENTUM}' END")
_ITEMS = [
    (0, "revenue_momentum", _MOM, "true"),
    (1, "largest_contributor", "pos1 || ' was the largest positive segment contributor.'", "has AND pos1 IS NOT NULL"),
    (2, "secondary_contributor", "pos2 || ' was the second positive contributor.'", "has AND pos2 IS NOT NULL"),
    (3, "principal_headwind", "neg1 || ' was the segment headwind.'", "has AND neg1 IS NOT NULL"),
    (4, "positive_signal", "pos_signal || ' was a major positive product signal.'", "has AND pos_signal IS NOT NULL"),
    (5, "negative_signal", "neg_signal || ' were negative product signals.'",
     "has AND coalesce(neg_signal <> '', false)"),
    (6, "management_context", "context_statement", "has AND context_statement IS NOT NULL"),
    (7, "profitability", f"'{N.PROFITABILITY_TEXT}'", f"coalesce(net_margin_pct >= {N.NET_MARGIN_STRONG}, false)"),
]
_PE = " UNION ALL ".join(
    f"SELECT {K}, {_HEAD} AS headline, {pos} AS pos, '{cat}' AS category, {text} AS text FROM x WHERE {cond}"
    for pos, cat, text, cond in _ITEMS)
_PRIO = "CASE category " + " ".join(f"WHEN '{c}' THEN {i + 1}" for i, c in enumerate(N.VISIBLE_PRIORITY)) + " END"

NARRATIVE_CTES = [("rnk", _RANK), ("drv", _DRIVERS), ("x", _X), ("pe", _PE)]


def _sql(select: str) -> str:
    return with_all("fx_long", *QD._PK, extra=QG.GROUNDING_CTES + QD._BASE + NARRATIVE_CTES) + "\n" + select


def _scoped(fx):
    return QG.scoped_inputs(fx)


# ------------------------------------------------------------- text oracles
def _fb(x: str) -> str:
    return (f"(CASE WHEN {x} IS NULL OR isnan(CAST({x} AS DOUBLE)) THEN 'Not available' ELSE "
            f"'$' || format('{{:,.1f}}', CAST({x} AS DOUBLE) / 1e9) || 'B' END)")


def _fp(x: str, sign: bool = False) -> str:
    s = f"CASE WHEN CAST({x} AS DOUBLE) > 0 THEN '+' ELSE '' END || " if sign else ""
    return (f"(CASE WHEN {x} IS NULL OR isnan(CAST({x} AS DOUBLE)) THEN 'Not available' ELSE "
            f"{s}format('{{:,.1f}}', CAST({x} AS DOUBLE)) || '%' END)")


def _dir(x: str) -> str:
    return (f"(CASE WHEN {x} IS NULL THEN 'was unavailable' WHEN {x} > 0 THEN 'increased' "
            f"WHEN {x} < 0 THEN 'declined' ELSE 'was unchanged' END)")


def _cap(x: str) -> str:
    return f"(upper(left({x}, 1)) || lower(substr({x}, 2)))"


_LATEST = ("(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY fiscal_year "
           "DESC, quarter_number DESC) AS rn FROM pm) x WHERE rn = 1)")
_PM = ("SELECT *, LAG(gross_margin_pct) OVER w AS p_g, LAG(operating_margin_pct) OVER w AS p_o, "
       "LAG(net_margin_pct) OVER w AS p_n FROM sq WINDOW w AS (PARTITION BY entity_id ORDER BY fiscal_year, "
       "quarter_number)")


def _text_sql(select: str) -> str:
    return with_all("fx_long", extra=QG.GROUNDING_CTES[:8] + [("pm", _PM)]) + "\n" + select


_KPI_SQL = _text_sql(f"""
SELECT entity_id, fiscal_year, fiscal_period, 'FY' || CAST(fiscal_year AS VARCHAR) || ' ' || fiscal_period AS period_label,
  {_fb('revenue')} AS revenue_text, {_fb('net_income')} AS net_income_text,
  {_fp('revenue_qoq_growth_pct', True)} AS qoq_text, {_fp('revenue_yoy_growth_pct', True)} AS yoy_text,
  {_fp('gross_margin_pct')} AS gross_margin_text, {_fp('operating_margin_pct')} AS operating_margin_text,
  {_fp('net_margin_pct')} AS net_margin_text, {_dir('revenue_qoq_change')} AS qoq_direction,
  {_dir('revenue_yoy_change')} AS yoy_direction,
  CASE WHEN revenue_yoy_growth_pct > 0 THEN 'positive' WHEN revenue_yoy_growth_pct < 0 THEN 'negative'
       ELSE 'neutral' END AS yoy_tone
FROM {_LATEST} l""")

_REPORT_SQL = _text_sql(f"""
SELECT entity_id, 'FY' || CAST(fiscal_year AS VARCHAR) AS "Fiscal year", {_fb('revenue')} AS "Revenue",
  {_fp('revenue_yoy_growth_pct')} AS "Revenue growth", {_fb('gross_profit')} AS "Gross profit",
  {_fb('operating_income')} AS "Operating income", {_fb('net_income')} AS "Net income",
  {_fp('gross_margin_pct')} AS "Gross margin", {_fp('operating_margin_pct')} AS "Operating margin",
  {_fp('net_margin_pct')} AS "Net margin"
FROM sa""")


def _growth_sql(v: str, cmp: str) -> str:
    return (f"(CASE WHEN {v} IS NULL THEN 'Revenue growth {cmp} was unavailable' ELSE 'revenue ' || {_dir(v)} "
            f"|| ' ' || {_fp(f'abs({v})')} || ' {cmp}' END)")


def _mdir(cur: str, prev: str, label: str) -> str:
    return (f"CASE WHEN {cur} IS NULL OR {prev} IS NULL THEN NULL WHEN abs({cur} - {prev}) < 0.05 THEN "
            f"'{label} margin held steady' WHEN {cur} - {prev} > 0 THEN '{label} margin improved' "
            f"ELSE '{label} margin declined' END")


_PARTS = (f"list_filter([{_mdir('gross_margin_pct', 'p_g', 'gross')}, {_mdir('operating_margin_pct', 'p_o', 'operating')}, "
          f"{_mdir('net_margin_pct', 'p_n', 'net')}], lambda x: x IS NOT NULL)")
_INSIGHT_ROWS = f"""
  SELECT entity_id, fiscal_year, fiscal_period, 0 AS pos, 'Current scale' AS title,
    'Entity ' || CAST(entity_id AS VARCHAR) || ' reported ' || {_fb('revenue')} || ' in revenue for FY'
      || CAST(fiscal_year AS VARCHAR) || ' ' || fiscal_period || '.' AS body FROM lt
  UNION ALL SELECT entity_id, fiscal_year, fiscal_period, 1, 'Growth momentum',
    {_cap(_growth_sql('revenue_yoy_growth_pct', 'year over year'))} || ' and '
      || {_growth_sql('revenue_qoq_growth_pct', 'from the prior quarter')} || '.' FROM lt
  UNION ALL SELECT entity_id, fiscal_year, fiscal_period, 2, 'Profitability',
    'Gross margin was ' || {_fp('gross_margin_pct')} || ', operating margin was ' || {_fp('operating_margin_pct')}
      || ', and net margin was ' || {_fp('net_margin_pct')} || '.' FROM lt
  UNION ALL SELECT entity_id, fiscal_year, fiscal_period, 3, 'What deserves attention',
    CASE WHEN len(parts) = 0 THEN NULL WHEN len(parts) = 1 THEN {_cap('parts[1]')} || '.'
         ELSE {_cap("array_to_string(list_slice(parts, 1, len(parts) - 1), ', ')")} || ', and ' || parts[len(parts)]
              || ' versus the prior quarter.' END
    FROM (SELECT *, {_PARTS} AS parts FROM lt) m"""
_INSIGHTS_SQL = _text_sql(f"SELECT * FROM ({_INSIGHT_ROWS.replace('FROM lt', 'FROM ' + _LATEST + ' l')}) x WHERE body IS NOT NULL")
# the insights of every period as one text
INSIGHT_TEXTS = [("pm", _PM), ("insight_text", f"""SELECT {K}, string_agg(body, ' ' ORDER BY pos) AS body
FROM ({_INSIGHT_ROWS.replace('FROM lt', 'FROM pm')}) x WHERE body IS NOT NULL GROUP BY {K}""")]


@register("format_kpis", sql=_KPI_SQL)
def q_format_kpis(spark, sf_dir):
    """KPI text of every entity's latest quarter (exact strings tested in pytest)."""
    analytics, _ = _scoped(Fixtures(spark, sf_dir))
    return N.kpis(A.latest_quarter(analytics))


@register("annual_report_table", sql=_REPORT_SQL)
def q_annual_report_table(spark, sf_dir):
    """Formatted annual report table of complete years."""
    _, annual = _scoped(Fixtures(spark, sf_dir))
    return N.report_table(annual)


@register("quarterly_report_table", sql=_text_sql(f"""
SELECT entity_id, 'FY' || CAST(fiscal_year AS VARCHAR) AS "Fiscal year", fiscal_period AS "Quarter", {_fb('revenue')} AS "Revenue",
  {_fb('gross_profit')} AS "Gross profit", {_fb('operating_income')} AS "Operating income", {_fb('net_income')} AS "Net income" FROM sq"""))
def q_quarterly_report_table(spark, sf_dir):
    """Formatted quarterly report table."""
    analytics, _ = _scoped(Fixtures(spark, sf_dir))
    return N.quarterly_report_table(analytics)


@register("executive_insights", sql=_INSIGHTS_SQL)
def q_executive_insights(spark, sf_dir):
    """H2: deterministic executive insights per entity."""
    analytics, _ = _scoped(Fixtures(spark, sf_dir))
    return N.executive_insights(analytics)


@register("margin_direction", sql=with_all("fx_long", extra=QG.GROUNDING_CTES[:7]) + f"""
SELECT {K}, margin, direction FROM (
  SELECT {K}, m.margin, CASE WHEN cur IS NULL OR prev IS NULL THEN NULL
      WHEN abs(cur - prev) < 0.05 THEN 'held steady' WHEN cur - prev > 0 THEN 'improved' ELSE 'declined' END
      AS direction
  FROM (SELECT *, LAG(gross_margin_pct) OVER w AS p_g, LAG(operating_margin_pct) OVER w AS p_o,
               LAG(net_margin_pct) OVER w AS p_n
        FROM sq WINDOW w AS (PARTITION BY entity_id ORDER BY fiscal_year, quarter_number)) s,
  LATERAL (VALUES ('gross', gross_margin_pct, p_g), ('operating', operating_margin_pct, p_o),
                  ('net', net_margin_pct, p_n)) m(margin, cur, prev)
) y WHERE direction IS NOT NULL""")
def q_margin_direction(spark, sf_dir):
    """Margin direction against the previous row (|change| < 0.05 is steady)."""
    analytics, _ = _scoped(Fixtures(spark, sf_dir))
    return N.margin_directions(analytics)


def summaries(spark, sf_dir):
    """Knowledge rows of every grounded period with their summaries."""
    return N.with_summary(QC.knowledge(Fixtures(spark, sf_dir)))


def _pe(spark, sf_dir):
    return N.plain_english(summaries(spark, sf_dir))


@register("plain_english", sql=_sql("SELECT * FROM pe"))
def q_plain_english(spark, sf_dir):
    """H3: headline and ordered takeaways for every grounded period."""
    return _pe(spark, sf_dir)


_SOURCES = f"""SELECT {K}, list_sort(list(source_id)) AS source_ids FROM (
  SELECT DISTINCT {K}, source_id FROM gf
  UNION SELECT {K}, source_id FROM pk_sources WHERE ({K}) IN (SELECT ({K}) FROM recon WHERE valid)) s GROUP BY {K}"""


@register("narrative_sources", sql=_sql(f"""
SELECT p.entity_id, p.fiscal_year, p.fiscal_period, p.headline, p.pos, p.category, s.source_ids AS summary_sources,
  CASE WHEN p.category IN ('revenue_momentum', 'profitability') THEN f.source_ids
       ELSE list_filter(s.source_ids, lambda x: NOT list_contains(f.source_ids, x)) END AS source_ids
FROM pe p JOIN ({_SOURCES}) s USING ({K})
JOIN (SELECT {K}, list_sort(list(DISTINCT source_id)) AS source_ids FROM gf GROUP BY ALL) f USING ({K})"""))
def q_narrative_sources(spark, sf_dir):
    """The sorted sources of every summary and of each of its takeaways."""
    x = summaries(spark, sf_dir).select(*D.PACKET, "headline", F.col("source_ids").alias("summary_sources"),
                                        each("takeaways").alias("t"))
    return x.select(*D.PACKET, "headline", "t.pos", "t.category", "summary_sources", "t.source_ids")


@register("visible_takeaways", sql=_sql(f"""
SELECT {K}, visible_rank, category, text FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY {K} ORDER BY {_PRIO}) AS INTEGER) AS visible_rank FROM pe
  WHERE {_PRIO} IS NOT NULL) t WHERE visible_rank <= 4"""))
def q_visible_takeaways(spark, sf_dir):
    """first four takeaways by fixed category priority."""
    return N.visible_takeaways(_pe(spark, sf_dir))


def _presentation(spark, sf_dir):
    return N.driver_presentation(KN.packets_in_force(Fixtures(spark, sf_dir).packets))


_SIG_IN = ", ".join(f"'{m}'" for m in N.PRIORITY_SIGNAL_METRICS)
_EXP_IN = ", ".join(f"'{e}'" for e in N.PRIORITY_EXPLANATION_IDS)


@register("driver_signals", sql=_sql(f"""
SELECT {K}, section, count(*) AS items FROM (
  SELECT {K}, CASE WHEN direction = 'positive' THEN 'contributor' ELSE 'headwind' END AS section FROM rnk
  UNION ALL SELECT DISTINCT {K}, 'signal' || metric FROM pk_facts
    WHERE kind = 'product_indicator' AND metric IN ({_SIG_IN}) AND ({K}) IN (SELECT ({K}) FROM recon WHERE valid)
  UNION ALL SELECT {K}, 'explanation' FROM pk_explanations
    WHERE explanation_id IN ({_EXP_IN}) AND ({K}) IN (SELECT ({K}) FROM recon WHERE valid)
  UNION ALL SELECT {K}, 'source' FROM pk_sources WHERE ({K}) IN (SELECT ({K}) FROM recon WHERE valid)
) s GROUP BY {K}, CASE WHEN section LIKE 'signal%' THEN 'signal' ELSE section END""".replace(
    "GROUP BY entity_id, fiscal_year, fiscal_period, CASE WHEN section LIKE 'signal%' THEN 'signal' ELSE section END",
    "GROUP BY ALL").replace("section, count(*)", "CASE WHEN section LIKE 'signal%' THEN 'signal' ELSE section END "
                                                   "AS section, count(*)")))
def q_driver_signals(spark, sf_dir):
    """Presentation items per valid packet and section (counts)."""
    return _presentation(spark, sf_dir).groupBy(*D.PACKET, "section").agg(F.count(F.lit(1)).alias("items"))


def _signed_billions_sql(v: str) -> str:
    """Integral USD -> billions to 3 places, half-even, in exact integer arithmetic."""
    a = f"abs(CAST({v} AS HUGEINT))"
    t = (f"({a} // 1000000 + CASE WHEN {a} % 1000000 > 500000 OR ({a} % 1000000 = 500000 "
         f"AND ({a} // 1000000) % 2 = 1) THEN 1 ELSE 0 END)")
    b = f"(CAST({t} // 1000 AS VARCHAR) || '.' || lpad(CAST({t} % 1000 AS VARCHAR), 3, '0'))"
    return (f"(CASE WHEN {v} > 0 THEN '+' WHEN {v} < 0 THEN '-' ELSE '' END || '$' || {b} || 'B')")


def _trim_sql(v: str) -> str:
    s = f"CAST(CAST({v} AS DECIMAL(38,6)) AS VARCHAR)"
    return f"(CASE WHEN contains({s}, '.') THEN regexp_replace(regexp_replace({s}, '0+$', ''), '\\.$', '') ELSE {s} END)"


_SIG_CASE = "CASE metric " + " ".join(f"WHEN '{m}' THEN {i + 1}" for i, m in enumerate(N.PRIORITY_SIGNAL_METRICS)) + " END"
_EXP_CASE = "CASE explanation_id " + " ".join(
    f"WHEN '{e}' THEN {i + 1}" for i, e in enumerate(N.PRIORITY_EXPLANATION_IDS)) + " END"
_VALID_K = f"({K}) IN (SELECT ({K}) FROM recon WHERE valid)"
_PRESENTATION_SQL = _sql(f"""
SELECT {K}, CASE WHEN direction = 'positive' THEN 'contributor' ELSE 'headwind' END AS section,
  CAST(rank AS INTEGER) AS pos, segment AS label,
  {_signed_billions_sql('absolute_revenue_change')} || ' | '
    || CAST(CAST(contribution_pct AS DECIMAL(38,2)) AS VARCHAR) || '%' AS value, direction AS tone
FROM rnk
UNION ALL
SELECT {K}, 'signal', CAST({_SIG_CASE} AS INTEGER), label,
  CASE WHEN unit = 'percent' THEN CASE WHEN value > 0 THEN '+' ELSE '' END || {_trim_sql('value')} || '%'
       WHEN unit = 'usd' THEN {_signed_billions_sql('value')}
       WHEN unit = 'count' THEN CASE WHEN qualifier = 'more_than' THEN 'More than ' ELSE '' END
         || CASE WHEN value >= 1000000 AND value % 1000000 = 0 THEN CAST(CAST(value AS BIGINT) // 1000000 AS VARCHAR) || ' million'
                 ELSE format('{{:,}}', CAST(value AS BIGINT)) END ELSE {_trim_sql('value')} END,
  CASE WHEN unit = 'percent' THEN CASE WHEN value > 0 THEN 'positive' WHEN value < 0 THEN 'negative'
       ELSE 'neutral' END ELSE 'neutral' END
FROM (SELECT {K}, metric, arg_max(label, pos) AS label, arg_max(value, pos) AS value, arg_max(unit, pos) AS unit,
        arg_max(qualifier, pos) AS qualifier
      FROM pk_facts WHERE kind = 'product_indicator' AND {_VALID_K} GROUP BY ALL) i
WHERE {_SIG_CASE} IS NOT NULL
UNION ALL
SELECT {K}, 'explanation', CAST({_EXP_CASE} AS INTEGER), attribution, statement, 'neutral'
FROM pk_explanations WHERE {_VALID_K} AND {_EXP_CASE} IS NOT NULL
UNION ALL
SELECT {K}, 'source', CAST(row_number() OVER (PARTITION BY {K} ORDER BY source_id) AS INTEGER), title, url, 'neutral'
FROM pk_sources WHERE {_VALID_K}""")


@register("driver_presentation", sql=_PRESENTATION_SQL)
def q_driver_presentation(spark, sf_dir):
    """The presentation rows themselves (signed billions, shares, signals)."""
    return _presentation(spark, sf_dir)
