"""Provider documents: declared shapes, strict parsing and acceptance.

A response is untrusted text.  It becomes an approved document only when it
is there, parses as JSON, fits its shape (``rules``), names the requested
period and passes the content checks of ``claims`` or ``qa`` against the
period's knowledge row.  The first failing stage and its reason stay with
every refused response, so nothing vanishes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterline.functions.arrays import where_late
from quarterline.operators import claims as C
from quarterline.operators.grounding import PERIOD_METRICS
from quarterline.operators.rules import Amount, Listed, Record, Text, Whole, as_texts, typed, violations

# Domains and bounds of the documents.
UNITS = ("usd", "percent", "count")
CATEGORIES = ("current_performance", "change", "profitability", "attention", "overall_performance", "primary_drivers",
              "headwinds", "profitability_context", "investigate_next")
PROVENANCE = ("reported", "derived", "management_explanation", "ai_interpretation")
ANSWER_CLASSES = ("reported_fact", "derived_metric", "management_explanation", "ai_interpretation")
NO_RESPONSE = "Provider response must be JSON text."
NO_JSON = "Provider response is not valid JSON."
NO_DRIVERS_STATUS = "Approved business-driver context is not available."
NO_BRIEFING_STATUS = "A validated AI briefing is not available."
VALIDATED_STATUS = "Validated against approved financial and business-driver sources."
WRONG_PERIOD = "Provider response period does not match the requested period."


def _repeats(ids: str) -> str:
    return f"size({ids}) <> size(array_distinct({ids}))"


def _outside(used: str, declared: str) -> str:
    return f"size(array_except({used}, {declared})) > 0"


# an insight that lists sources has a claim on another one
def _undeclared_claims(i: str) -> str:
    used = f"concat(transform({i}.figure_claims, c -> c.source_id), flatten(transform({i}.business_claims, c -> c.source_ids)))"
    return f"size({i}.source_ids) > 0 AND {_outside(used, i + '.source_ids')}"


def _unnamed_metrics(a: str) -> str:
    metrics = f"transform({a}.claims, c -> c.metric)"
    return f"{_outside(metrics, a + '.metric_names')} OR {_outside(a + '.metric_names', metrics)}"


PERIOD = Record({"fiscal_year": Whole(1900, 9999), "fiscal_period": Text(one_of=("Q1", "Q2", "Q3", "Q4"))})
FIGURE_CLAIM = Record({"metric": Text(one_of=tuple(PERIOD_METRICS)), "value": Amount(), "unit": Text(one_of=UNITS),
                       "source_id": Text()})
BUSINESS_CLAIM = Record({"metric": Text(), "value": Amount(), "unit": Text(one_of=UNITS),
                         "classification": Text(one_of=("reported", "derived")), "source_ids": Listed(Text(), least=1)})
INSIGHT = Record({
    "category": Text(one_of=CATEGORIES), "title": Text(80), "narrative": Text(500),
    "classification": Text(one_of=PROVENANCE, required=False, default="ai_interpretation"),
    "source_ids": Listed(Text(), required=False), "figure_claims": Listed(FIGURE_CLAIM, required=False),
    "business_claims": Listed(BUSINESS_CLAIM, required=False), "management_explanation_ids": Listed(Text(), required=False),
}, checks=(("claim_sources", _undeclared_claims),))
BRIEFING = Record({
    "schema_version": Text(one_of=("1.0",), required=False, default="1.0"), "entity": Text(required=False),
    "reporting_period": PERIOD, "headline": Text(140), "executive_summary": Text(800), "insights": Listed(INSIGHT, 1, 6),
    "source_ids": Listed(Text(), least=1),
}, checks=(("duplicate_sources", lambda b: _repeats(f"{b}.source_ids")),))

_MANAGED = "classification = 'management_explanation'"
_NUMERIC = "classification <> 'management_explanation'"
ANSWER_CLAIM = Record({
    "metric": Text(), "classification": Text(one_of=ANSWER_CLASSES), "value": Amount(required=False, nullable=True),
    "unit": Text(one_of=UNITS, required=False, nullable=True), "source_ids": Listed(Text(), least=1),
    "management_explanation_id": Text(required=False, nullable=True),
}, checks=(
    ("duplicate_sources", lambda c: _repeats(f"{c}.source_ids")),
    ("explanation_required", lambda c: f"{c}.{_MANAGED} AND {c}.management_explanation_id IS NULL"),
    ("numeric_management", lambda c: f"{c}.{_MANAGED} AND ({c}.value IS NOT NULL OR {c}.unit IS NOT NULL)"),
    ("number_required", lambda c: f"{c}.{_NUMERIC} AND ({c}.value IS NULL OR {c}.unit IS NULL)"),
    ("explanation_forbidden", lambda c: f"{c}.{_NUMERIC} AND {c}.management_explanation_id IS NOT NULL"),
))
ANSWER = Record({
    "schema_version": Text(one_of=("1.0",), required=False, default="1.0"), "reporting_period": PERIOD,
    "status": Text(one_of=("supported", "insufficient_context")), "answer": Text(1200),
    "plain_language_explanation": Text(800, required=False, nullable=True), "claims": Listed(ANSWER_CLAIM, most=12),
    "metric_names": Listed(Text(), most=12), "source_ids": Listed(Text(), most=12),
    "suggested_investigation_areas": Listed(Text(160), most=5),
}, checks=(
    ("duplicate_sources", lambda a: _repeats(f"{a}.source_ids")),
    ("supported_facts", lambda a: f"{a}.status = 'supported' AND (size({a}.claims) = 0 OR size({a}.source_ids) = 0)"),
    ("unsupported_facts", lambda a: f"{a}.status = 'insufficient_context' AND "
                                    f"(size({a}.claims) > 0 OR size({a}.metric_names) > 0 OR size({a}.source_ids) > 0)"),
    ("claim_sources", lambda a: _outside(f"flatten(transform({a}.claims, c -> c.source_ids))", f"{a}.source_ids")),
    ("metric_names", _unnamed_metrics),
))


def parsed(responses: DataFrame, shape: Record, text: str = "response") -> DataFrame:
    """``responses`` with ``document`` (typed; NULL unless it fits), ``json_ok`` and ``shape_violations``."""
    x = responses.withColumn("_v", F.try_parse_json(text))
    x = x.withColumn("_found", violations(shape, "_v"))
    ok = F.col("_v").isNotNull()
    return x.select(*responses.columns, F.when(ok & (F.size("_found") == 0), typed(shape, "_v")).alias("document"),
                    ok.alias("json_ok"), F.when(ok, as_texts(F.col("_found"))).alias("shape_violations"))


def briefing_columns(parsed_: DataFrame) -> DataFrame:
    """The columns ``claims.validated`` reads, from a parsed briefing on its knowledge row."""
    d = F.col("document")
    none = F.slice(d["insights"], 1, 0)
    return parsed_.withColumns({
        "claimed_fiscal_year": d["reporting_period"]["fiscal_year"], "claimed_fiscal_period": d["reporting_period"]["fiscal_period"],
        "source_ids": F.coalesce(d["source_ids"], F.array().cast("array<string>")),
        "insights": F.coalesce(d["insights"], none)})


def accepted_briefings(responses: DataFrame, text: str = "response") -> DataFrame:
    """Responses on their knowledge rows with ``accepted``, and the first failing ``stage`` and its ``reason``.

    Stages: transport (no text), syntax, schema, period, then the contract of
    I2 with all errors of I1.  ``document`` is NULL unless accepted.
    """
    x = parsed(responses, BRIEFING, text)
    x = C.validated(briefing_columns(x)).withColumn("_failure", C.contract_failure())
    slipped = ((F.col("claimed_fiscal_year") != F.col("fiscal_year")) | (F.col("claimed_fiscal_period") != F.col("fiscal_period")))
    stage = (F.when(F.col(text).isNull(), "transport").when(~F.col("json_ok"), "syntax")
             .when(F.size("shape_violations") > 0, "schema").when(slipped, "period")
             .when(F.col("_failure") == "claims", "claims").when(F.col("_failure").isNotNull(), "contract"))
    x = x.withColumn("stage", stage)
    reason = (F.when(F.col("stage") == "transport", F.lit(NO_RESPONSE)).when(F.col("stage") == "syntax", F.lit(NO_JSON))
              .when(F.col("stage") == "schema", F.array_join("shape_violations", "; "))
              .when(F.col("stage") == "period", F.lit(WRONG_PERIOD))
              .when(F.col("stage").isNotNull(), C.contract_reason(F.col("_failure"))))
    accepted = F.col("stage").isNull()
    return x.withColumns({"reason": reason, "accepted": accepted, "document": F.when(accepted, F.col("document"))}).drop("_failure")


def knowledge_digest(figures: str = "figures") -> Column:
    """SHA-256 of everything approved about a period: a stored document need not be checked again while it stays."""
    return F.sha2(F.to_json(F.struct(F.col(figures).alias("figures"), "packet")), 256)


def stored_rows(accepted: DataFrame, text: str = "response") -> DataFrame:
    """The accepted documents as store rows, with the digests of their text and of what they were checked against."""
    return where_late(accepted, "accepted").select(
        *C.DOC, F.col(text).alias("document"), F.sha2(text, 256).alias("document_digest"), knowledge_digest().alias("knowledge_digest"))


def revalidated(stored: DataFrame) -> DataFrame:
    """A10: stored documents on their *current* knowledge rows, approved again or refused.

    A document whose text and knowledge have the stored digests is approved
    without another look; every other one passes the whole acceptance again.
    ``status``: approved, stale (period or claims no longer hold), malformed
    (text no longer a document) or no_context (the period is not grounded).
    """
    x = stored.withColumn("reevaluated", ~F.coalesce(
        (F.sha2("document", 256) == F.col("document_digest")) & (knowledge_digest() == F.col("knowledge_digest")), F.lit(False)))
    # unchanged documents are not even parsed
    x = x.withColumn("_text", F.when(F.col("reevaluated"), F.col("document"))).withColumnRenamed("document", "_document")
    x = accepted_briefings(x, "_text")
    mismatched = F.size(F.filter("figure_states", lambda s: s["status"] != "match")).cast("bigint")
    status = (F.when(~F.col("reevaluated"), "approved").when(F.col("stage").isin("transport", "syntax", "schema"), "malformed")
              .when(F.col("figures").isNull(), "no_context").when(F.col("stage").isNotNull(), "stale").otherwise("approved"))
    return x.withColumns({"claim_errors": F.when(F.col("reevaluated") & F.col("json_ok"), mismatched).otherwise(0).cast("bigint"),
                          "status": status}).drop("document").withColumnRenamed("_document", "document")


def display_selection(periods: DataFrame) -> DataFrame:
    """I8: per period the approved briefing if there is one, else the deterministic text, with its status.

    ``periods``: knowledge rows with ``complete`` (an approved briefing is
    stored), ``ai_text`` and ``fallback_text``.
    """
    good = F.coalesce(F.col("complete"), F.lit(False))
    shown = F.col("available") & good
    status = (F.when(~F.col("available"), F.lit(NO_DRIVERS_STATUS)).when(~good, F.lit(NO_BRIEFING_STATUS)).otherwise(F.lit(VALIDATED_STATUS)))
    return periods.select(*C.DOC, F.when(shown, "ai").otherwise("deterministic").alias("mode"), status.alias("status"),
                          F.when(shown, F.col("ai_text")).otherwise(F.col("fallback_text")).alias("content"))
