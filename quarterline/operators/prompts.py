"""Prompts for a provider: instructions, approved context with business drivers, question, history and output shape.

All JSON is deterministic: keys in alphabetical order at every level, exact
decimals as text, absent parts as null.  The context of a period is built once
on its knowledge row, and a question's prompt takes it from there.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterline.functions.arrays import no_texts
from quarterline.functions.periods import period_identifier
from quarterline.operators import documents as DOC
from quarterline.operators import grounding as G
from quarterline.operators import knowledge as KN
from quarterline.operators.rules import json_schema

# The instructions of both prompts.
BRIEFING_INSTRUCTIONS = (
    "Write a source-grounded executive briefing from the approved context only. Use no outside knowledge. "
    "Copy approved values exactly and never estimate or recalculate a figure. "
    "Keep reported facts, derived metrics, management explanations and interpretations apart, and attribute "
    "explanations to management. Every insight lists its source IDs; every numeric claim names the approved metric, "
    "value, unit, classification and source. Give no investment advice, forecast or price target. "
    "Answer with JSON of the given schema and one insight in each category: overall_performance, primary_drivers, "
    "headwinds, profitability_context, attention, investigate_next.")
QA_INSTRUCTIONS = (
    "Answer from the approved financial context only. Use no outside knowledge and no tools, and never guess or "
    "recalculate. Where the context does not answer the question, return insufficient_context. Every claim names its "
    "exact approved metric, value, unit, classification and source IDs; attribute explanations to management. "
    "Give no forecast, price target or investment advice. Answer with JSON of the given schema.")


def schema_text(shape: object) -> str:
    return json.dumps(json_schema(shape), sort_keys=True, ensure_ascii=False)


def _record(fields: dict[str, Column]) -> Column:
    """A struct with its fields in alphabetical order."""
    return F.struct(*[fields[n].alias(n) for n in sorted(fields)])


def drivers() -> Column:
    """The business-driver part of a knowledge row: packet and derived ranking, or why there is none."""
    fy, fp = F.col("fiscal_year").cast("int"), F.col("fiscal_period")
    has, p = KN.available(), F.col("packet")

    def period(year: Column, quarter: Column) -> Column:
        return _record({"fiscal_period": quarter, "fiscal_year": year.cast("int")})

    def facts(kind: str) -> Column:
        return F.transform(F.filter(p["facts"], lambda f: f["kind"] == kind), lambda f: _record({
            **{n: f[n] for n in ("classification", "label", "metric", "qualifier", "source_ids", "unit")},
            "value": G.plain_decimal(f["value"])}))

    def names(side: str) -> Column:
        return F.transform(p[side], lambda c: c["segment"])

    packet = _record({
        "derived_metrics": no_texts(), "entity": F.concat(F.lit("Entity "), F.col("entity_id").cast("string")),
        "management_explanations": F.transform(p["explanations"], lambda e: _record({n: e[n] for n in (
            "attribution", "classification", "explanation_id", "source_ids", "statement")})),
        "product_indicators": facts("product_indicator"), "reported_facts": facts("reported_fact"),
        "reporting_period": period(fy, fp), "schema_version": F.lit("1.0"),
        "segment_results": F.transform(p["segments"], lambda s: _record({
            "classification": s["classification"], "segment": s["segment"], "source_ids": s["source_ids"],
            **{n: G.plain_decimal(s[n]) for n in ("current_revenue", "prior_year_revenue", "reported_growth_pct")}})),
        "sources": F.transform(p["sources"], lambda s: _record({
            "reporting_period": period(s["source_fiscal_year"], s["source_fiscal_period"]),
            **{n: s[n] for n in ("source_id", "source_type", "title", "url")}}))})
    ranking = _record({
        "classification": F.lit("derived"), "negative_contributors": names("negative"), "positive_contributors": names("positive"),
        "contributions": F.transform(p["contributions"], lambda c: _record({
            "absolute_revenue_change": c["absolute_revenue_change"].cast("string"), "classification": F.lit("derived"),
            "contribution_pct": c["share"].cast("decimal(38,2)").cast("string"), "segment": c["segment"], "source_ids": c["source_ids"]})),
        "reporting_period": period(fy, fp), "total_revenue_change": p["reported_increase"].cast("string")})
    reason = F.coalesce(p["first_violation"], F.concat(
        F.lit("No approved business-driver packet exists for "), period_identifier("fiscal_year", "fiscal_period"), F.lit(".")))
    return _record({
        "availability": F.when(has, "available").otherwise("unavailable"), "derived_ranking": F.when(has, ranking),
        "packet": F.when(has, packet), "reporting_period": period(fy, fp), "unavailable_reason": F.when(~has, reason)})


def with_context(knowledge: DataFrame) -> DataFrame:
    """Knowledge rows with ``context_json``, everything approved about the period."""
    return knowledge.withColumn("_drivers", drivers()).withColumn("context_json", G.context_json(F.col("_drivers"))).drop("_drivers")


def briefing_prompts(knowledge: DataFrame) -> DataFrame:
    """H9: the briefing prompt of every grounded period."""
    return with_context(knowledge).select(*KN.PERIOD, F.lit(BRIEFING_INSTRUCTIONS).alias("system_instructions"), "context_json",
                                          F.lit(schema_text(DOC.BRIEFING)).alias("output_schema_json"))


def qa_prompts(requests: DataFrame, history: DataFrame) -> DataFrame:
    """H9: the prompt of every provider request.

    ``requests``: session_id, turn, question, context_json.  ``history``:
    session_id, turn, history (``qa.history``); a request without one has an
    empty list.
    """
    told = F.transform("history", lambda h: F.struct(h["answer"].alias("answer"), h["question"].alias("question")))
    x = requests.join(history.select("session_id", "turn", F.to_json(told).alias("_told")), ["session_id", "turn"], "left")
    return x.select("session_id", "turn", F.lit(QA_INSTRUCTIONS).alias("system_instructions"),
                    F.regexp_replace("question", r"^\s+|\s+$", "").alias("question"), "context_json",
                    F.coalesce("_told", F.lit("[]")).alias("history_json"),
                    F.lit(schema_text(DOC.ANSWER)).alias("output_schema_json"))
