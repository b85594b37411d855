"""File scans: facts documents, all-text CSV and contracted exports, written from the test tables and read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from quarterline.functions.metrics import CONCEPT_OF_METRIC
from quarterline.operators import analytics as A
from quarterline.plans import q_analytics as QA
from quarterline.plans.catalog import Fixtures, register
from quarterline.plans.fixture_sql import with_all, with_fixtures
from quarterline.session import scratch_path
from quarterline.sources import exports as X
from quarterline.sources import facts_json as J

LOST = CONCEPT_OF_METRIC["net_income"]
# Landed documents that are broken, by (entity_id * 3 + fy) % 7.
TRUNCATED, LACKS_CONCEPT, NEVER_LANDED, FRACTIONS = 1, 2, 3, 4


@register("facts_scan_report", sql=with_fixtures("fx_obs") + f"""
SELECT CAST(entity_id AS VARCHAR) || '-' || CAST(fy AS VARCHAR) AS doc_id,
  CASE k WHEN {NEVER_LANDED} THEN 'missing' WHEN {TRUNCATED} THEN 'malformed' ELSE 'ok' END AS status,
  CASE WHEN k NOT IN ({NEVER_LANDED}, {TRUNCATED}) THEN list_sort(list_filter([{', '.join(repr(c) for c in sorted(CONCEPT_OF_METRIC.values()))}],
    lambda c: NOT list_contains(concepts, c) OR (k = {LACKS_CONCEPT} AND c = '{LOST}'))) END AS missing_concepts,
  CAST(CASE WHEN k NOT IN ({NEVER_LANDED}, {TRUNCATED}) THEN n - CASE WHEN k = {LACKS_CONCEPT} THEN lost ELSE 0 END END AS BIGINT) AS observations,
  CAST(CASE WHEN k NOT IN ({NEVER_LANDED}, {TRUNCATED}) THEN CASE WHEN k = {FRACTIONS} THEN n ELSE 0 END END AS BIGINT) AS fractional_values
FROM (SELECT entity_id, fy, (entity_id * 3 + fy) % 7 AS k, count(*) AS n, count(*) FILTER (WHERE concept = '{LOST}') AS lost,
        list(DISTINCT concept) AS concepts FROM fx_obs GROUP BY entity_id, fy) d""")
def q_facts_scan_report(spark, sf_dir):
    """A1: facts documents landed as files, some broken or never landed; one report row per expected document."""
    docs = J.documents_from_observations(Fixtures(spark, sf_dir).obs)
    k = (F.split("doc_id", "-").getItem(0).cast("bigint") * 3 + F.split("doc_id", "-").getItem(1).cast("int")) % 7
    text = F.col("json")
    broken = (F.when(k == TRUNCATED, F.substring(text, 1, 50)).when(k == LACKS_CONCEPT, F.replace(text, F.lit(f'"{LOST}":'), F.lit('"Other":')))
              .when(k == FRACTIONS, F.regexp_replace(text, r'"val":(-?\d+)', '"val":$1.5')).otherwise(text))
    path = scratch_path(spark, "documents")
    docs.select("doc_id", F.when(k != NEVER_LANDED, broken).alias("json")).write.json(path)
    landed = J.read_document_lines(spark, path)
    expected = landed.select("doc_id")  # what the filer announced: every envelope, landed or not
    return J.document_report(landed.where(F.col("json").isNotNull()), expected)


_RAW = ["entity_id", "metric", "sec_metric", "start_date", "end_date", "fiscal_year", "fiscal_period", "value", "form",
        "filed_date", "accession_number"]


@register("raw_csv_scan", sql=with_fixtures("fx_raw") + f"""
SELECT {', '.join(f"CAST({c} AS VARCHAR) AS {c}" for c in _RAW)} FROM fx_raw""")
def q_raw_csv_scan(spark, sf_dir):
    """A2: the long facts written as CSV with a header and scanned back as text, no inference."""
    path = scratch_path(spark, "raw-csv")
    Fixtures(spark, sf_dir).raw.select(*_RAW).write.option("header", True).csv(path)
    return X.read_text_csv(spark, path, _RAW)


_WHOLE = ["fiscal_year"]


@register("export_scan_report", sql=with_all("fx_long", extra=[
    ("w", QA._WIDE), ("l", QA._LAGGED), ("qa", QA._ANALYTICS), ("atot", QA._ANNUAL_TOTALS), ("an", QA._ANNUAL)]) + """
SELECT 'quarterly_analytics' AS export_name, 'ok' AS status, '' AS missing_columns, count(*) AS rows, CAST(0 AS BIGINT) AS bad_rows FROM qa
UNION ALL SELECT 'annual_financials', 'missing_columns', 'net_margin_pct', count(*), 0 FROM an
UNION ALL SELECT 'latest_quarter', 'empty', '', 0, 0
UNION ALL SELECT 'quarterly_financials', 'bad_rows', '', count(*), CAST(count(*) FILTER (WHERE entity_id % 5 = 0) AS BIGINT) FROM w
UNION ALL SELECT 'segment_summary', 'missing_file', '', 0, 0""")
def q_export_scan_report(spark, sf_dir):
    """A3: exports written as CSV -- one whole, one without a column, one empty, one with bad rows, one never written -- and their scans."""
    wide = A.quarterly_wide(Fixtures(spark, sf_dir).long)
    qa = A.quarterly_analytics(wide)
    frames = {
        "quarterly_analytics": qa, "annual_financials": A.annual_financials(A.annual_totals(wide)).drop("net_margin_pct"),
        "latest_quarter": A.latest_quarter(qa).where("entity_id < 0"),
        "quarterly_financials": wide.withColumn("fiscal_year", F.when(F.col("entity_id") % 5 == 0, "n/a").otherwise(
            F.col("fiscal_year").cast("string")))}
    base = scratch_path(spark, "exports")
    for name, df in frames.items():
        df.write.option("header", True).csv(f"{base}/{name}")
    contracts = {**X.EXPORT_COLUMNS, "segment_summary": ["segment"]}
    reports = [X.scan_export(spark, f"{base}/{name}", columns, _WHOLE)[1].select(F.lit(name).alias("export_name"), "*")
               for name, columns in contracts.items()]
    return reduce(lambda a, b: a.unionByName(b), reports)
