"""Business-driver packet queries: reconcile, rule checks, contributions, ranking."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterline.functions.periods import period_identifier
from quarterline.operators import analytics as A
from quarterline.operators import drivers as D
from quarterline.plans.catalog import SCOPE_MIN_FISCAL_YEAR, Fixtures, register
from quarterline.plans.fixture_sql import half_up_div, with_all
from quarterline.sources.testdata import ATTRIBUTION, URL_PREFIX

K = "entity_id, fiscal_year, fiscal_period"
_PK = ("pk_head", "pk_sources", "pk_facts", "pk_segments", "pk_explanations")

_RECS = f"""SELECT {K}, kind AS record_kind, metric AS record_key, unnest(source_ids) AS source_id FROM pk_facts
UNION ALL SELECT {K}, 'segment_result', segment, unnest(source_ids) FROM pk_segments
UNION ALL SELECT {K}, 'management_explanation', explanation_id, unnest(source_ids) FROM pk_explanations"""
_ORPHANS = """SELECT r.* FROM recs r WHERE NOT EXISTS (SELECT 1 FROM pk_sources s WHERE s.entity_id = r.entity_id
  AND s.fiscal_year = r.fiscal_year AND s.fiscal_period = r.fiscal_period AND s.source_id = r.source_id)"""
_FLAGS = {
    "duplicate_sources": "coalesce(src.duplicate_sources, false)",
    "source_period": "coalesce(src.source_period, false)",
    "unsupported_sources": "(o.entity_id IS NOT NULL)",
    "derived_stored": "(h.derived_metric_count > 0)",
    "missing_facts": "(fv.revenue IS NULL OR fv.prior_year_quarter_revenue IS NULL OR fv.revenue_increase IS NULL)",
    "current_mismatch": "(NOT {m} AND NOT coalesce(seg.current_total = fv.revenue, false))",
    "prior_mismatch": "(NOT {m} AND NOT coalesce(seg.prior_total = fv.prior_year_quarter_revenue, false))",
    "change_mismatch": "(NOT {m} AND NOT coalesce(seg.change_total = fv.revenue_increase, false))",
}
_MISSING = _FLAGS["missing_facts"]
_FLAGS = {k: v.replace("{m}", _MISSING) for k, v in _FLAGS.items()}
_MSGS = [f"CASE WHEN {_FLAGS[name]} THEN '{msg}' END" for name, msg in D.RULES]
_RECON = f"""SELECT h.entity_id, h.fiscal_year, h.fiscal_period,
  CAST(seg.current_total AS BIGINT) AS current_total, CAST(seg.prior_total AS BIGINT) AS prior_total,
  CAST(seg.change_total AS BIGINT) AS change_total, CAST(fv.revenue AS BIGINT) AS reported_revenue,
  CAST(fv.revenue_increase AS BIGINT) AS reported_increase,
  {", ".join(f"{_FLAGS[name]} AS {name}" for name, _ in D.RULES)},
  concat_ws(' ', {", ".join(_MSGS)}) AS violations,
  coalesce({", ".join(_MSGS)}) AS first_violation,
  coalesce({", ".join(_MSGS)}) IS NULL AS valid
FROM pk_head h
LEFT JOIN (SELECT {K}, count(source_id) <> count(DISTINCT source_id) AS duplicate_sources,
                  bool_or(source_fiscal_year <> fiscal_year OR source_fiscal_period <> fiscal_period) AS source_period
           FROM pk_sources GROUP BY ALL) src USING ({K})
LEFT JOIN (SELECT DISTINCT {K} FROM orph) o USING ({K})
LEFT JOIN (SELECT {K}, arg_max(value, pos) FILTER (WHERE metric = 'revenue') AS revenue,
                  arg_max(value, pos) FILTER (WHERE metric = 'prior_year_quarter_revenue') AS prior_year_quarter_revenue,
                  arg_max(value, pos) FILTER (WHERE metric = 'revenue_increase') AS revenue_increase
           FROM pk_facts WHERE kind = 'reported_fact' GROUP BY ALL) fv USING ({K})
LEFT JOIN (SELECT {K}, sum(current_revenue) AS current_total, sum(prior_year_revenue) AS prior_total,
                  sum(current_revenue - prior_year_revenue) AS change_total FROM pk_segments GROUP BY ALL) seg
  USING ({K})"""
_CONTRIB = f"""SELECT s.entity_id, s.fiscal_year, s.fiscal_period, s.segment,
  CAST(s.current_revenue - s.prior_year_revenue AS BIGINT) AS absolute_revenue_change,
  {half_up_div('100 * (s.current_revenue - s.prior_year_revenue)', 'r.reported_increase', 2)} AS contribution_pct,
  'derived' AS classification, s.source_ids
FROM pk_segments s JOIN recon r USING ({K}) WHERE r.valid AND r.reported_increase <> 0"""

_BASE = [("recs", _RECS), ("orph", _ORPHANS), ("recon", _RECON), ("contrib", _CONTRIB)]


def _sql(select: str) -> str:
    return with_all(*_PK, extra=_BASE) + "\n" + select


def _packets(spark, sf_dir):
    return Fixtures(spark, sf_dir).packets


@register("segment_reconcile", sql=_sql("SELECT * FROM recon"))
def q_segment_reconcile(spark, sf_dir):
    """Segment sums vs reported facts, every packet rule flag, first failing rule."""
    return D.reconciliation(_packets(spark, sf_dir))


@register("orphan_sources", sql=_sql("SELECT * FROM orph"))
def q_orphan_sources(spark, sf_dir):
    """Record source IDs missing from the packet's approved sources."""
    return D.orphan_sources(_packets(spark, sf_dir))


@register("segment_contribution", sql=_sql("SELECT * FROM contrib"))
def q_segment_contribution(spark, sf_dir):
    """Change and contribution share per segment of every valid packet."""
    return D.contributions(_packets(spark, sf_dir))


@register("segment_ranking", sql=_sql(f"""
SELECT {K}, direction, segment, absolute_revenue_change, contribution_pct,
  CAST(row_number() OVER (PARTITION BY {K}, direction ORDER BY CASE WHEN direction = 'positive'
    THEN -absolute_revenue_change ELSE absolute_revenue_change END, segment) AS INTEGER) AS rank
FROM (SELECT *, CASE WHEN absolute_revenue_change > 0 THEN 'positive' ELSE 'negative' END AS direction
      FROM contrib WHERE absolute_revenue_change <> 0) x"""))
def q_segment_ranking(spark, sf_dir):
    """Deterministic positive / negative contributor ranking."""
    return D.ranking(_packets(spark, sf_dir))


@register("packet_violations", sql=with_all(*_PK) + f"""
SELECT {K}, {", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in (
    "bad_classification", "non_integer_value", "bad_source_list", "seg_bad_classification", "seg_bad_source_list",
    "bad_url", "bad_source_type", "bad_explanation", "bad_unit", "bad_qualifier", "missing_value", "seg_non_integer",
    "empty_records"))},
  CAST(coalesce(bad_classification, 0) + coalesce(non_integer_value, 0) + coalesce(bad_source_list, 0)
     + coalesce(seg_bad_classification, 0) + coalesce(seg_bad_source_list, 0) + coalesce(bad_url, 0)
     + coalesce(bad_source_type, 0) + coalesce(bad_explanation, 0) + coalesce(bad_unit, 0) + coalesce(bad_qualifier, 0)
     + coalesce(missing_value, 0) + coalesce(seg_non_integer, 0) + empty_records AS BIGINT) AS violations
FROM (SELECT h.*, CAST(NOT EXISTS (SELECT 1 FROM pk_explanations e WHERE e.entity_id = h.entity_id
        AND e.fiscal_year = h.fiscal_year AND e.fiscal_period = h.fiscal_period) AS INTEGER)
      + CAST(NOT EXISTS (SELECT 1 FROM pk_facts f WHERE f.kind = 'product_indicator' AND f.entity_id = h.entity_id
        AND f.fiscal_year = h.fiscal_year AND f.fiscal_period = h.fiscal_period) AS INTEGER) AS empty_records
      FROM pk_head h) hd
LEFT JOIN (SELECT {K}, sum(CASE WHEN classification <> 'reported' THEN 1 ELSE 0 END) AS bad_classification,
  sum(CASE WHEN unit IN ('usd', 'count') AND value <> floor(value) THEN 1 ELSE 0 END) AS non_integer_value,
  sum(CASE WHEN len(source_ids) <> len(list_distinct(source_ids)) OR len(source_ids) = 0 THEN 1 ELSE 0 END)
    AS bad_source_list, sum(CASE WHEN unit NOT IN ('usd', 'percent', 'count') THEN 1 ELSE 0 END) AS bad_unit,
  sum(CASE WHEN qualifier NOT IN ('exact', 'more_than') THEN 1 ELSE 0 END) AS bad_qualifier,
  sum(CASE WHEN value IS NULL OR trim(label) = '' THEN 1 ELSE 0 END) AS missing_value FROM pk_facts GROUP BY ALL) f USING ({K})
LEFT JOIN (SELECT {K}, sum(CASE WHEN classification <> 'reported' THEN 1 ELSE 0 END) AS seg_bad_classification,
  sum(CASE WHEN len(source_ids) <> len(list_distinct(source_ids)) THEN 1 ELSE 0 END) AS seg_bad_source_list,
  sum(CASE WHEN current_revenue <> floor(current_revenue) OR prior_year_revenue <> floor(prior_year_revenue) THEN 1 ELSE 0 END)
    AS seg_non_integer
  FROM pk_segments GROUP BY ALL) s USING ({K})
LEFT JOIN (SELECT {K}, sum(CASE WHEN NOT starts_with(url, '{URL_PREFIX}') THEN 1 ELSE 0 END) AS bad_url,
  sum(CASE WHEN source_type NOT IN ('press_release', 'metrics', 'earnings_call') THEN 1 ELSE 0 END) AS bad_source_type
  FROM pk_sources GROUP BY ALL) src USING ({K})
LEFT JOIN (SELECT {K}, sum(CASE WHEN attribution <> '{ATTRIBUTION}' OR classification <> 'management_explanation'
  THEN 1 ELSE 0 END) AS bad_explanation FROM pk_explanations GROUP BY ALL) e USING ({K})""")
def q_packet_violations(spark, sf_dir):
    """Record-level packet rules, counted per rule and packet."""
    return D.schema_violations(_packets(spark, sf_dir), URL_PREFIX, ATTRIBUTION)


@register("packet_availability", sql=with_all("fx_long", *_PK, extra=_BASE) + f"""
SELECT q.entity_id, q.fiscal_year, q.fiscal_period,
  CASE WHEN r.entity_id IS NULL THEN 'unavailable' WHEN r.valid THEN 'available' ELSE 'invalid' END AS availability,
  CASE WHEN r.entity_id IS NULL THEN 'No approved business-driver packet exists for FY'
         || CAST(q.fiscal_year AS VARCHAR) || '-' || q.fiscal_period || '.'
       ELSE r.first_violation END AS reason
FROM (SELECT DISTINCT entity_id, fiscal_year, fiscal_period FROM fx_long
      WHERE fiscal_year >= {SCOPE_MIN_FISCAL_YEAR}) q
LEFT JOIN recon r USING ({K})""")
def q_packet_availability(spark, sf_dir):
    """A5: every requested period gets an explicit available / unavailable / invalid state."""
    fx = Fixtures(spark, sf_dir)
    periods = A.scoped(A.quarterly_wide(fx.long), SCOPE_MIN_FISCAL_YEAR).select(*D.PACKET)
    recon = D.reconciliation(fx.packets).withColumn("_has", F.lit(True))
    x = periods.join(recon, D.PACKET, "left")
    return x.select(
        *D.PACKET,
        F.when(F.col("_has").isNull(), "unavailable").when(F.col("valid"), "available").otherwise("invalid")
        .alias("availability"),
        F.when(F.col("_has").isNull(), F.concat(F.lit("No approved business-driver packet exists for "),
                                                period_identifier("fiscal_year", "fiscal_period"), F.lit(".")))
        .otherwise(F.col("first_violation")).alias("reason"),
    )


# How the written documents are broken, by key (SQL that both engines read).
BROKEN_DOCS = {
    "truncated": "entity_id % 5 = 4 AND fiscal_period = 'Q2'",
    "wrong_type": "entity_id % 5 = 3 AND fiscal_period = 'Q4'",
    "missing_field": "entity_id % 5 = 2 AND fiscal_period = 'Q2'",
    "array": "entity_id % 5 = 1 AND fiscal_period = 'Q4'",
}
_BROKEN = "(" + " OR ".join(f"({c})" for c in BROKEN_DOCS.values()) + ")"


@register("packet_json_scan", sql=with_all(*_PK) + f"""
SELECT file_name, doc, broken AS malformed, CASE WHEN NOT broken THEN entity_id END AS entity_id,
  CASE WHEN NOT broken THEN fiscal_year END AS fiscal_year, CASE WHEN NOT broken THEN fiscal_period END AS fiscal_period,
  CASE WHEN NOT broken AND extra THEN 1 ELSE 0 END AS unknown_field_count,
  CASE WHEN NOT broken AND extra THEN 'reviewer_note' ELSE '' END AS unknown_fields,
  NOT broken AND NOT stale AS period_matches,
  CASE WHEN NOT broken THEN sources END AS sources, CASE WHEN NOT broken THEN segments END AS segments
FROM (SELECT h.entity_id, h.fiscal_year, h.fiscal_period,
    CAST(h.entity_id AS VARCHAR) || '/' || CAST(h.fiscal_year AS VARCHAR) || '/' || h.fiscal_period AS doc,
    'FY' || CAST(h.fiscal_year - CASE WHEN h.entity_id % 4 = 3 AND h.fiscal_period = 'Q3' THEN 1 ELSE 0 END AS VARCHAR) || '-'
      || h.fiscal_period || '.json' AS file_name,
    {_BROKEN.replace("entity_id", "h.entity_id").replace("fiscal_period", "h.fiscal_period")} AS broken,
    h.entity_id % 3 = 2 AND h.fiscal_period = 'Q1' AS extra, h.entity_id % 4 = 3 AND h.fiscal_period = 'Q3' AS stale,
    CAST(s.n AS INTEGER) AS sources, CAST(g.n AS INTEGER) AS segments
  FROM pk_head h
  JOIN (SELECT {K}, count(*) AS n FROM pk_sources GROUP BY ALL) s USING ({K})
  JOIN (SELECT {K}, count(*) AS n FROM pk_segments GROUP BY ALL) g USING ({K})) x""")
def q_packet_json_scan(spark, sf_dir):
    """A5: packets written as JSON documents by Spark, some broken by key, parsed back
    with an explicit schema and checked strictly (broken documents, unknown fields,
    file period vs packet period)."""
    from quarterline.sources import packets_json as PJ

    p = _packets(spark, sf_dir)
    extra = (F.col("entity_id") % 3 == 2) & (F.col("fiscal_period") == "Q1")
    docs = PJ.packets_to_json(p, extra_field=extra)
    stale_name = (F.col("entity_id") % 4 == 3) & (F.col("fiscal_period") == "Q3")
    docs = docs.withColumn("file_name", F.when(stale_name, F.concat(
        F.lit("FY"), (F.col("fiscal_year") - 1).cast("string"), F.lit("-Q3.json"))).otherwise(F.col("file_name")))
    text = F.col("json")
    broken = (F.when(F.expr(BROKEN_DOCS["truncated"]), F.substring(text, 1, 60))
              .when(F.expr(BROKEN_DOCS["wrong_type"]), F.regexp_replace(text, r'"entity_id":\d+', '"entity_id":"x"'))
              .when(F.expr(BROKEN_DOCS["missing_field"]), F.regexp_replace(text, r'"schema_version":"1.0",', ""))
              .when(F.expr(BROKEN_DOCS["array"]), F.concat(F.lit("["), text, F.lit("]"))).otherwise(text))
    name = F.concat_ws("/", F.col("entity_id").cast("string"), F.col("fiscal_year").cast("string"), "fiscal_period")
    parsed = PJ.strict_parse(docs.select("file_name", name.alias("doc"), broken.alias("json")))
    pk = F.col("packet")
    ok = ~F.col("malformed")
    return parsed.select(
        "file_name", "doc", "malformed", pk["entity_id"].alias("entity_id"),
        pk["reporting_period"]["fiscal_year"].alias("fiscal_year"),
        pk["reporting_period"]["fiscal_period"].alias("fiscal_period"),
        F.size("unknown_fields").alias("unknown_field_count"),
        F.array_join("unknown_fields", ",").alias("unknown_fields"), "period_matches",
        F.when(ok, F.size(pk["sources"])).alias("sources"), F.when(ok, F.size(pk["segment_results"])).alias("segments"))
