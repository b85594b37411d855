"""Quality checks over the dirty all-text copy of the long facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterline.operators import quality as Q
from quarterline.plans.catalog import QUALITY_MIN_FISCAL_YEAR, Fixtures, register
from quarterline.plans.fixture_sql import with_all

_RAW = with_all("fx_raw")
_EXPECTED = "(VALUES ('gross_profit'), ('net_income'), ('operating_income'), ('revenue')) m(metric)"

_METRICS_SQL = f"""
SELECT e.entity_id, m.metric, 'missing' AS issue FROM (SELECT DISTINCT entity_id FROM fx_raw) e, {_EXPECTED}
WHERE NOT EXISTS (SELECT 1 FROM fx_raw r WHERE r.entity_id = e.entity_id AND r.metric = m.metric)
UNION ALL
SELECT DISTINCT entity_id, metric, 'unexpected' FROM fx_raw
WHERE metric NOT IN ('gross_profit', 'net_income', 'operating_income', 'revenue')"""

_DUP_SQL = """SELECT entity_id, metric, fiscal_year, fiscal_period, count(*) AS n FROM fx_raw
GROUP BY entity_id, metric, fiscal_year, fiscal_period HAVING count(*) > 1"""

_MISSING_SQL = f"""SELECT k.entity_id, k.metric, k.fiscal_year, p.fiscal_period
FROM (SELECT DISTINCT entity_id, metric, fiscal_year FROM fx_raw
      WHERE TRY_CAST(fiscal_year AS BIGINT) >= {QUALITY_MIN_FISCAL_YEAR}) k,
     (VALUES ('Q1'), ('Q2'), ('Q3'), ('Q4')) p(fiscal_period)
WHERE NOT EXISTS (SELECT 1 FROM fx_raw r WHERE r.entity_id = k.entity_id AND r.metric = k.metric
                  AND r.fiscal_year = k.fiscal_year AND r.fiscal_period = p.fiscal_period)"""

_VALUES_SQL = """SELECT entity_id, metric, fiscal_year, fiscal_period, value FROM fx_raw
WHERE TRY_CAST(trim(value) AS BIGINT) IS NULL OR TRY_CAST(trim(value) AS BIGINT) = 0"""


@register("raw_csv_quality", sql=_RAW + "\nSELECT * FROM fx_raw")
def q_raw_csv_quality(spark, sf_dir):
    """A2: the all-text long facts every check reads (what an all-STRING CSV scan yields)."""
    return Fixtures(spark, sf_dir).raw


@register("coerce_numeric", sql=_RAW + """
SELECT entity_id, metric, fiscal_period, CAST(TRY_CAST(trim(fiscal_year) AS DECIMAL(38,6)) AS DOUBLE) AS fiscal_year,
  CAST(TRY_CAST(trim(value) AS DECIMAL(38,6)) AS DOUBLE) AS value FROM fx_raw""")
def q_coerce_numeric(spark, sf_dir):
    """A4: numeric coercion of every non-text column, bad text -> NULL."""
    raw = Fixtures(spark, sf_dir).raw.select("entity_id", "metric", "fiscal_period", "fiscal_year", "value")
    out = Q.coerce_numeric(raw, {"entity_id", "metric", "fiscal_period"})
    return out.select("entity_id", "metric", "fiscal_period",
                      F.col("fiscal_year").cast("double").alias("fiscal_year"),
                      F.col("value").cast("double").alias("value"))


@register("dq_metrics", sql=_RAW + _METRICS_SQL)
def q_dq_metrics(spark, sf_dir):
    """Missing and unexpected metrics per entity."""
    return Q.metric_domain(Fixtures(spark, sf_dir).raw)


@register("dq_duplicates", sql=_RAW + "\n" + _DUP_SQL)
def q_dq_duplicates(spark, sf_dir):
    """Duplicate (entity, metric, year, period) keys."""
    return Q.duplicate_keys(Fixtures(spark, sf_dir).raw)


@register("dq_missing_periods", sql=_RAW + "\n" + _MISSING_SQL)
def q_dq_missing_periods(spark, sf_dir):
    """Expected quarters absent for observed (entity, metric, year >= floor)."""
    return Q.missing_periods(Fixtures(spark, sf_dir).raw, QUALITY_MIN_FISCAL_YEAR)


@register("dq_values", sql=_RAW + "\n" + _VALUES_SQL)
def q_dq_values(spark, sf_dir):
    """Non-integer or zero values."""
    return Q.invalid_values(Fixtures(spark, sf_dir).raw)


@register("dq_summary", sql=_RAW + f""",
bm AS ({_METRICS_SQL}), bd AS ({_DUP_SQL}), bp AS ({_MISSING_SQL}), bv AS ({_VALUES_SQL})
SELECT entity_id, count(*) AS rows,
  CAST(min(TRY_CAST(trim(fiscal_year) AS BIGINT)) AS INTEGER) AS min_fiscal_year,
  CAST(max(TRY_CAST(trim(fiscal_year) AS BIGINT)) AS INTEGER) AS max_fiscal_year,
  entity_id NOT IN (SELECT entity_id FROM bm) AS metrics_ok,
  entity_id NOT IN (SELECT entity_id FROM bd) AS duplicates_ok,
  entity_id NOT IN (SELECT entity_id FROM bp) AS periods_ok,
  entity_id NOT IN (SELECT entity_id FROM bv) AS values_ok,
  entity_id NOT IN (SELECT entity_id FROM bm UNION SELECT entity_id FROM bd UNION SELECT entity_id FROM bp
                    UNION SELECT entity_id FROM bv) AS passed
FROM fx_raw GROUP BY entity_id""")
def q_dq_summary(spark, sf_dir):
    """Row count, year range and pass/fail of every check, per entity."""
    return Q.summary(Fixtures(spark, sf_dir).raw, QUALITY_MIN_FISCAL_YEAR)


@register("base_table_constraints", sql=_RAW + """
SELECT entity_id, CAST(sum(n) AS BIGINT) AS rows, CAST(sum(nulls) AS BIGINT) AS not_null_violations,
  CAST(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS duplicate_keys,
  sum(nulls) = 0 AND sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) = 0 AS loadable
FROM (SELECT entity_id, metric, fiscal_year, fiscal_period, count(*) AS n,
        sum(CASE WHEN metric IS NULL OR sec_metric IS NULL OR start_date IS NULL OR end_date IS NULL
                 OR fiscal_year IS NULL OR fiscal_period IS NULL OR value IS NULL OR form IS NULL
                 THEN 1 ELSE 0 END) AS nulls
      FROM fx_raw GROUP BY entity_id, metric, fiscal_year, fiscal_period) k
GROUP BY entity_id""")
def q_base_table_constraints(spark, sf_dir):
    """NOT NULL and UNIQUE checks that gate the full-refresh load."""
    return Q.load_constraints(Fixtures(spark, sf_dir).raw)
