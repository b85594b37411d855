"""DuckDB text of the fixture tables, for the SQL oracle.

The oracle engine only sees the raw tables, so every oracle statement starts
with the fixture steps it needs as ``WITH ... AS MATERIALIZED`` CTEs.  The
definitions mirror ``quarterline.sources.testdata`` rule for rule, written
independently in plain SQL (nation grain).
"""

from __future__ import annotations

from quarterline.functions.metrics import CONCEPT_OF_METRIC, CORE_METRICS

_CONCEPT_CASE = "CASE metric " + " ".join(
    f"WHEN '{m}' THEN '{CONCEPT_OF_METRIC[m]}'" for m in CORE_METRICS
) + " END"


def q_start(fy: str, q: str) -> str:
    return f"CAST(make_date(CAST({fy} AS INTEGER) - 1, 7, 1) + to_months(3 * (CAST({q} AS INTEGER) - 1)) AS DATE)"


def q_end(fy: str, q: str) -> str:
    return f"CAST({q_start(fy, q)} + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)"


def pct(num: str, den: str) -> str:
    """``round(100 * num / nullif(den, 0), 2)`` evaluated exactly (half away from zero)."""
    n = f"CAST(({num}) AS HUGEINT)"
    d = f"CAST(({den}) AS HUGEINT)"
    return (
        f"(CASE WHEN ({den}) IS NULL OR ({den}) = 0 OR ({num}) IS NULL THEN NULL ELSE "
        f"sign({n}) * sign({d}) * ((abs({n}) * 20000 + abs({d})) // (2 * abs({d}))) / 100.0 END)"
    )


CTES: dict[str, tuple[list[str], str]] = {}


def _cte(name: str, deps: list[str], sql: str) -> None:
    CTES[name] = (deps, sql)


_cte("fx_lines", [], """
SELECT CAST(s.s_nationkey AS BIGINT) AS entity_id, p.p_brand AS segment,
       CAST(year(l.l_shipdate) + CASE WHEN month(l.l_shipdate) >= 7 THEN 1 ELSE 0 END AS INTEGER) AS fiscal_year,
       CAST(((month(l.l_shipdate) + 5) % 12) // 3 + 1 AS INTEGER) AS q,
       CAST(l.l_extendedprice AS DECIMAL(12,2)) AS p,
       CAST(l.l_discount AS DECIMAL(4,2)) AS d,
       CAST(l.l_tax AS DECIMAL(4,2)) AS t,
       l.l_returnflag AS rf
FROM lineitem l
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN part p ON l.l_partkey = p.p_partkey
""")

_cte("fx_wide", ["fx_lines"], """
SELECT entity_id, fiscal_year, q,
       CAST(sum(p) * 10000 AS BIGINT) AS revenue,
       CAST(sum(p * (1 - d)) * 10000 AS BIGINT) AS gross_profit,
       CAST(sum(p * (1 - d - t)) * 10000 AS BIGINT) AS operating_income,
       CAST(sum(CASE WHEN rf = 'R' THEN -p ELSE p * (1 - d - t) END) * 10000 AS BIGINT) AS net_income
FROM fx_lines GROUP BY entity_id, fiscal_year, q
""")

_cte("fx_long", ["fx_wide"], f"""
SELECT entity_id, metric, {_CONCEPT_CASE} AS sec_metric,
       {q_start('fiscal_year', 'q')} AS start_date,
       {q_end('fiscal_year', 'q')} AS end_date,
       fiscal_year, 'Q' || CAST(q AS VARCHAR) AS fiscal_period, q,
       CAST(value AS BIGINT) AS value,
       CASE WHEN q = 4 THEN 'DERIVED' ELSE '10-Q' END AS form,
       CAST({q_end('fiscal_year', 'q')} + INTERVAL (CASE WHEN q = 4 THEN 60 ELSE 25 END) DAY AS DATE) AS filed_date,
       'E-' || CAST(entity_id AS VARCHAR) || '-' || CAST(fiscal_year AS VARCHAR) || '-' || CAST(q AS VARCHAR)
           AS accession_number
FROM (
  SELECT entity_id, fiscal_year, q, 'revenue' AS metric, revenue AS value FROM fx_wide
  UNION ALL SELECT entity_id, fiscal_year, q, 'gross_profit', gross_profit FROM fx_wide
  UNION ALL SELECT entity_id, fiscal_year, q, 'operating_income', operating_income FROM fx_wide
  UNION ALL SELECT entity_id, fiscal_year, q, 'net_income', net_income FROM fx_wide
) u
""")

_cte("fx_segments", ["fx_lines"], """
SELECT entity_id, segment, fiscal_year, q, CAST(sum(p) * 10000 AS BIGINT) AS revenue
FROM fx_lines GROUP BY entity_id, segment, fiscal_year, q
""")

_cte("fx_year", ["fx_long"], """
SELECT entity_id, metric, fiscal_year,
       max(CASE WHEN q = 1 THEN value END) AS v1, max(CASE WHEN q = 2 THEN value END) AS v2,
       max(CASE WHEN q = 3 THEN value END) AS v3, max(CASE WHEN q = 4 THEN value END) AS v4
FROM fx_long GROUP BY entity_id, metric, fiscal_year
""")

_cte("fx_obs", ["fx_year"], f"""
SELECT entity_id, {_CONCEPT_CASE} AS concept, 'USD' AS unit, CAST(seq AS INTEGER) AS seq,
       CAST(CASE WHEN seq <= 4 THEN {q_start('fiscal_year', 'k')}
                 WHEN seq <= 7 THEN {q_start('fiscal_year', '1')} END AS VARCHAR) AS start_date,
       CAST({q_end('fiscal_year', 'k')} AS VARCHAR) AS end_date,
       CAST(CASE WHEN seq <= 2 THEN vk WHEN seq = 3 THEN vk + 7 WHEN seq = 4 THEN vk + 9
                 WHEN seq = 5 THEN v1 + v2 WHEN seq = 6 THEN v1 + v2 + v3
                 WHEN seq = 7 THEN coalesce(v1, 0) + coalesce(v2, 0) + coalesce(v3, 0) + v4
                 ELSE v4 END AS BIGINT) AS val,
       'A-' || CAST(entity_id AS VARCHAR) || '-' || CAST(fiscal_year AS VARCHAR) || '-' || CAST(k AS VARCHAR)
           || '-' || CAST(seq AS VARCHAR) AS accn,
       CAST(CASE WHEN seq = 2 THEN fiscal_year + 1 ELSE fiscal_year END AS INTEGER) AS fy,
       CASE WHEN seq <= 4 THEN 'Q' || CAST(k AS VARCHAR) WHEN seq = 5 THEN 'Q2' WHEN seq = 6 THEN 'Q3'
            ELSE 'FY' END AS fp,
       CASE WHEN seq >= 7 THEN '10-K' ELSE '10-Q' END AS form,
       CAST(CAST({q_end('fiscal_year', 'k')} + INTERVAL (CASE WHEN seq = 2 THEN 390 WHEN seq IN (3, 7, 8) THEN 60
            ELSE 25 END) DAY AS DATE) AS VARCHAR) AS filed
FROM (
  SELECT y.*, v.seq, v.k,
         CASE v.k WHEN 1 THEN y.v1 WHEN 2 THEN y.v2 WHEN 3 THEN y.v3 ELSE y.v4 END AS vk
  FROM fx_year y, (VALUES (1,1),(2,1),(3,1),(4,1),(1,2),(2,2),(3,2),(4,2),(1,3),(2,3),(3,3),(4,3),
                          (5,2),(6,3),(7,4),(8,4)) v(seq, k)
) x
WHERE CASE WHEN seq IN (1, 2) THEN vk IS NOT NULL
           WHEN seq = 3 THEN vk IS NOT NULL AND entity_id % 5 = 0
           WHEN seq = 4 THEN vk IS NOT NULL AND entity_id % 5 = 1
           WHEN seq = 5 THEN v1 IS NOT NULL AND v2 IS NOT NULL
           WHEN seq = 6 THEN v1 IS NOT NULL AND v2 IS NOT NULL AND v3 IS NOT NULL
                             AND NOT (entity_id % 7 = 0 AND fiscal_year = 1998)
           ELSE v4 IS NOT NULL END
""")


def with_fixtures(*names: str) -> str:
    """``WITH a AS MATERIALIZED (...), ...`` for ``names`` and their dependencies."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in CTES[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({CTES[n][1]})" for n in order)


def with_all(*names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Fixture CTEs plus extra query-specific ``(name, sql)`` CTEs."""
    head = with_fixtures(*names) if names else ""
    parts = [head] if head else []
    for n, s in extra or []:
        parts.append(f"{n} AS MATERIALIZED ({s})")
    if not names:
        return "WITH " + ",\n".join(parts)
    return ",\n".join(parts)


_cte("fx_raw", ["fx_long"], """
SELECT entity_id, CASE WHEN variant = 3 THEN 'other_income' ELSE metric END AS metric, sec_metric,
  CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date,
  CAST(fiscal_year AS VARCHAR) AS fiscal_year, fiscal_period,
  CASE WHEN entity_id % 6 = 0 AND q = 2 THEN 'n/a' WHEN entity_id % 6 = 1 AND q = 3 THEN '0'
       ELSE CAST(value AS VARCHAR) END AS value,
  CASE WHEN variant = 1 AND entity_id % 10 = 2 AND fiscal_year = 2001 AND q = 2 THEN NULL ELSE form END AS form,
  CAST(filed_date AS VARCHAR) AS filed_date, accession_number
FROM fx_long, (VALUES (1), (2), (3)) v(variant)
WHERE CASE WHEN variant = 1 THEN NOT (entity_id % 9 = 0 AND fiscal_year = 2000 AND q = 3 AND metric = 'gross_profit')
           WHEN variant = 2 THEN entity_id % 4 = 0 AND fiscal_year = 1999 AND q = 1
           ELSE entity_id % 8 = 3 AND fiscal_year = 2000 AND q = 1 AND metric = 'net_income' END
""")


def half_up_div(num: str, den: str, scale: int) -> str:
    """Exact ``round(num / den, scale)`` half away from zero, as DOUBLE (den != 0)."""
    n = f"CAST(({num}) AS HUGEINT)"
    d = f"CAST(({den}) AS HUGEINT)"
    k = 10 ** scale
    return (f"(sign({n}) * sign({d}) * ((abs({n}) * {2 * k} + abs({d})) // (2 * abs({d}))) / {float(k)})")


def _sid(kind: str, alias: str = "") -> str:
    a = f"{alias}." if alias else ""
    return (f"('e' || CAST({a}entity_id AS VARCHAR) || '-fy' || CAST({a}fiscal_year AS VARCHAR) || '-' || "
            f"{a}fiscal_period || '-{kind}')")


_cte("pk_head", ["fx_wide"], """
SELECT c.entity_id, c.fiscal_year, 'Q' || CAST(c.q AS VARCHAR) AS fiscal_period, c.q, c.revenue,
       p.revenue AS prior_revenue, CASE WHEN c.entity_id % 17 = 2 THEN 1 ELSE 0 END AS derived_metric_count
FROM fx_wide c JOIN fx_wide p ON c.entity_id = p.entity_id AND p.fiscal_year + 1 = c.fiscal_year AND p.q = c.q
""")

_cte("pk_sources", ["pk_head"], """
SELECT entity_id, fiscal_year, fiscal_period,
  'e' || CAST(entity_id AS VARCHAR) || '-fy' || CAST(fiscal_year AS VARCHAR) || '-' || fiscal_period || '-'
      || CASE WHEN entity_id % 23 = 16 AND t.source_type = 'metrics' THEN 'press_release' ELSE t.source_type END AS source_id,
  CAST(CASE WHEN t.source_type = 'metrics' AND entity_id % 19 = 6 THEN fiscal_year - 1 ELSE fiscal_year END
       AS INTEGER) AS source_fiscal_year,
  fiscal_period AS source_fiscal_period,
  CASE WHEN entity_id % 23 = 14 AND t.source_type = 'earnings_call' THEN 'blog' ELSE t.source_type END AS source_type,
  'Entity ' || CAST(entity_id AS VARCHAR) || ' FY' || CAST(fiscal_year AS VARCHAR) || ' ' || fiscal_period || ' '
      || t.source_type AS title,
  CASE WHEN entity_id % 23 = 13 AND t.source_type = 'metrics' THEN 'http://elsewhere.example.org/'
       ELSE 'https://investor.example.com/' END || 'e' || CAST(entity_id AS VARCHAR) || '/fy' || CAST(fiscal_year AS VARCHAR) || '-'
      || lower(fiscal_period) || '/' || t.source_type AS url
FROM pk_head, (VALUES ('press_release'), ('metrics'), ('earnings_call')) t(source_type)
""")

_cte("pk_facts", ["pk_head"], f"""
SELECT entity_id, fiscal_year, fiscal_period, kind, pos, metric, label, value,
       CASE WHEN entity_id % 23 = 21 AND unit = 'percent' THEN 'ratio' ELSE unit END AS unit,
       CASE WHEN entity_id % 23 = 22 AND kind = 'product_indicator' THEN 'about'
            WHEN unit = 'count' AND entity_id % 2 = 0 THEN 'more_than' ELSE 'exact' END AS qualifier,
       CASE WHEN entity_id % 23 = 9 AND kind = 'product_indicator' THEN 'derived' ELSE 'reported' END AS classification,
       source_ids FROM (
  SELECT entity_id, fiscal_year, fiscal_period, 'reported_fact' AS kind, 0 AS pos, 'revenue' AS metric,
         'Revenue' AS label,
         CAST(revenue + CASE WHEN entity_id % 7 = 3 THEN 1 ELSE 0 END AS DECIMAL(38,6)) AS value, 'usd' AS unit,
         CASE WHEN entity_id % 11 = 5 THEN [{_sid('press_release')}, 'unapproved-source']
              ELSE [{_sid('press_release')}] END AS source_ids
  FROM pk_head
  UNION ALL SELECT entity_id, fiscal_year, fiscal_period, 'reported_fact', 1, 'prior_year_quarter_revenue',
         'Prior-year-quarter revenue', CAST(prior_revenue + CASE WHEN entity_id % 23 = 19 THEN 1 ELSE 0 END AS DECIMAL(38,6)), 'usd',
         [{_sid('press_release')}]
  FROM pk_head
  UNION ALL SELECT entity_id, fiscal_year, fiscal_period, 'reported_fact', 2, 'revenue_increase', 'Revenue increase',
         CAST(revenue - prior_revenue + CASE WHEN entity_id % 23 = 20 THEN 1 ELSE 0 END AS DECIMAL(38,6)), 'usd',
         [{_sid('press_release')}]
  FROM pk_head WHERE entity_id % 23 <> 18
  UNION ALL SELECT entity_id, fiscal_year, fiscal_period, 'product_indicator', 0, 'revenue_growth_pct',
         'Revenue growth', CAST({pct('revenue - prior_revenue', 'prior_revenue')} AS DECIMAL(38,6)), 'percent',
         CASE WHEN entity_id % 23 = 10 THEN [{_sid('metrics')}, {_sid('metrics')}] ELSE [{_sid('metrics')}] END
  FROM pk_head WHERE prior_revenue <> 0
  UNION ALL SELECT entity_id, fiscal_year, fiscal_period, 'product_indicator', 1, 'revenue', 'Revenue (indicator)',
         CAST(revenue + 1000 + CASE WHEN entity_id % 26 = 17 THEN 0.5 ELSE 0 END AS DECIMAL(38,6)), 'usd', [{_sid('metrics')}]
  FROM pk_head WHERE entity_id % 13 = 4
  UNION ALL SELECT entity_id, fiscal_year, fiscal_period, 'product_indicator', 2, 'active_customers', 'Active customers',
         CAST(CASE WHEN q <= 2 THEN (entity_id + 1) * 1000000 ELSE revenue % 10000000 END AS DECIMAL(38,6)), 'count',
         [{_sid('metrics')}]
  FROM pk_head
) f
""")

_cte("pk_segments", ["fx_segments", "pk_head"], f"""
SELECT entity_id, fiscal_year, 'Q' || CAST(q AS VARCHAR) AS fiscal_period, segment,
  CAST(coalesce(cur, 0) AS BIGINT) AS current_revenue, CAST(coalesce(pri, 0) AS BIGINT) AS prior_year_revenue,
  CAST(CASE WHEN coalesce(pri, 0) = 0 THEN 0
       ELSE {half_up_div('100 * (coalesce(cur, 0) - coalesce(pri, 0))', 'coalesce(pri, 0)', 0)} END
       AS DECIMAL(38,6)) AS reported_growth_pct,
  CASE WHEN entity_id % 23 = 11 THEN 'derived' ELSE 'reported' END AS classification,
  list_resize(['e' || CAST(entity_id AS VARCHAR) || '-fy' || CAST(fiscal_year AS VARCHAR) || '-Q' || CAST(q AS VARCHAR)
   || '-press_release'], CASE WHEN entity_id % 23 = 12 THEN 2 ELSE 1 END, 'e' || CAST(entity_id AS VARCHAR) || '-fy'
   || CAST(fiscal_year AS VARCHAR) || '-Q' || CAST(q AS VARCHAR) || '-press_release') AS source_ids
FROM (SELECT entity_id, segment, fiscal_year, q, revenue AS cur FROM fx_segments) c
FULL OUTER JOIN (SELECT entity_id, segment, fiscal_year + 1 AS fiscal_year, q, revenue AS pri FROM fx_segments) p
  USING (entity_id, segment, fiscal_year, q)
WHERE (entity_id, fiscal_year, q) IN (SELECT (entity_id, fiscal_year, q) FROM pk_head)
""")

_cte("pk_explanations", ["pk_head"], f"""
SELECT entity_id, fiscal_year, fiscal_period, x.explanation_id, x.statement,
       CASE WHEN entity_id % 23 = 15 AND x.explanation_id = 'pricing' THEN 'Someone else' ELSE 'Entity management' END AS attribution,
       'management_explanation' AS classification, [{_sid('earnings_call')}] AS source_ids
FROM pk_head, (VALUES ('demand', 'Management said customer demand supported the quarter.'),
                      ('pricing', 'Management said pricing changes affected revenue.')) x(explanation_id, statement)
WHERE entity_id % 23 <> 8
""")
