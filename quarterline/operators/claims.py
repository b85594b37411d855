"""Claim validation against grounded figures and approved business claims.

A briefing stands on its period's knowledge row (``knowledge.knowledge``) with
its insights and their claims in arrays.  Every rule is an expression over
that row, and all errors are collected in reading order: rule, insight, claim.
Values compare in DECIMAL: USD / count exactly, percentages within 0.01
points inclusive.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterline.functions.arrays import each_with_pos, no_texts
from quarterline.operators import knowledge as KN
from quarterline.operators.drivers import PACKET
from quarterline.operators.grounding import plain_decimal

DOC = PACKET
# Tolerance for percent claims and the required briefing categories.
PERCENT_TOLERANCE = "0.01"
REQUIRED_CATEGORIES = ["attention", "headwinds", "investigate_next", "overall_performance", "primary_drivers",
                       "profitability_context"]
# Error texts; a name in braces stands for a value of the document.
ERRORS = {
    "period": "Briefing reporting period does not match grounding context.",
    "declared_sources": "Unsupported briefing source IDs: {sources}.",
    "insight_sources": "Unsupported insight source IDs: {sources}.",
    "duplicate": "Duplicate figure claim: {source}/{metric}.",
    "unsupported": "Unsupported figure claim: {source}/{metric}.",
    "wrong_unit": "Incorrect unit for {metric} from {source}.",
    "mismatch": "Figure mismatch for {metric} from {source}: claimed {claimed}, grounded {grounded}.",
    "business_unsupported": "Unsupported business-driver claim: {metric}.",
    "business_classification": "Incorrect classification for business-driver claim {metric}.",
    "business_unit": "Incorrect unit for business-driver claim {metric}.",
    "business_sources": "Incorrect source IDs for business-driver claim {metric}.",
    "business_mismatch": "Figure mismatch for business-driver claim {metric}.",
    "no_driver_context": "Management explanations require approved business-driver context.",
    "explanations": "Unsupported management explanations: {ids}.",
    "undeclared_sources": "Figure claims use undeclared source IDs: {sources}.",
}
CONTRACT = {
    "drivers_unavailable": "Approved business-driver context is unavailable.",
    "categories": "Briefing must contain each required executive category exactly once.",
    "insight_sources": "Every briefing insight requires source IDs.",
}


def values_match(claimed: Column, grounded: Column, unit: Column) -> Column:
    """I4: USD / count exact; percent within 0.01 inclusive (decimal arithmetic)."""
    c = claimed.cast("decimal(38,6)")
    g = grounded.cast("decimal(38,6)")
    return F.when(unit.isin("usd", "count"), c == g).otherwise(F.abs(c - g) <= F.lit(PERCENT_TOLERANCE).cast("decimal(38,6)"))


def figure_claim_status(claims: DataFrame, figures: DataFrame | None = None) -> DataFrame:
    """Per figure claim -- duplicate, unsupported, wrong_unit, mismatch, match.

    The duplicate check comes first and the key counts as seen even when it
    is unsupported; the grounded lookup goes by (document, source_id, metric).
    Without ``figures``, ``claims`` has a row per document with ``figures`` and
    ``claims`` in arrays (claims in reading order, a figure's key once), and
    nothing is shuffled.  Otherwise both are long tables.
    """
    if figures is None:
        return _nested_claim_status(claims)
    w = Window.partitionBy(*DOC, "source_id", "metric").orderBy("insight_pos", "claim_pos")
    c = claims.withColumn("_occ", F.row_number().over(w))
    g = figures.select(*DOC, "source_id", "metric", F.col("unit").alias("g_unit"), F.col("value").alias("g_value"))
    j = c.join(g, [*DOC, "source_id", "metric"], "left")
    status = _claim_status(F.col("_occ") > 1, F.col("unit"), F.col("value"), F.col("g_unit"), F.col("g_value"))
    return j.select(*DOC, "insight_pos", "claim_pos", "source_id", "metric", "unit",
                    F.col("value").cast("decimal(38,6)").alias("value"), F.col("g_value").alias("grounded_value"),
                    status.alias("status"))


def _claim_status(again: Column, unit: Column, value: Column, g_unit: Column, g_value: Column) -> Column:
    return (F.when(again, "duplicate").when(g_unit.isNull(), "unsupported").when(unit != g_unit, "wrong_unit")
            .when(~values_match(value, g_value, unit), "mismatch").otherwise("match"))


def _nested_claim_status(documents: DataFrame) -> DataFrame:
    def keys(name: str) -> Column:
        """(source_id, metric) as one text; its length parts the source from the metric, and NULL is a value of its own."""
        return F.transform(name, lambda e: F.concat(
            F.coalesce(F.concat(F.length(e["source_id"]).cast("string"), F.lit(":"), e["source_id"]), F.lit("")),
            F.coalesce(F.concat(F.lit("="), e["metric"]), F.lit(""))))

    # lists and claims are made once a document; the rest is flat work on a row per claim
    x = documents.select(*DOC, "claims", keys("claims").alias("_claimed"), keys("figures").alias("_grounded"),
                         F.col("figures.unit").alias("_units"), F.col("figures.value").alias("_values"))
    x = x.select(*DOC, "_claimed", "_grounded", "_units", "_values", each_with_pos("claims", "_at", "c"))
    x = x.withColumn("_key", F.element_at("_claimed", F.col("_at") + 1))
    # an unknown key part equals nothing
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in (*DOC, "c.source_id", "c.metric")])
    x = x.withColumn("_found", F.when(whole, (F.array_position("_grounded", F.col("_key")) - 1).cast("int")))
    x = x.withColumns({"_again": F.array_position("_claimed", F.col("_key")) <= F.col("_at"),
                       "g_unit": F.get("_units", F.col("_found")), "g_value": F.get("_values", F.col("_found"))})
    status = _claim_status(F.col("_again"), F.col("c.unit"), F.col("c.value"), F.col("g_unit"), F.col("g_value"))
    return x.select(*DOC, "c.insight_pos", "c.claim_pos", "c.source_id", "c.metric", "c.unit",
                    F.col("c.value").cast("decimal(38,6)").alias("value"), F.col("g_value").alias("grounded_value"),
                    status.alias("status"))


def _text(rule: str, **values: Column) -> Column:
    """The rule's error text with its values in place."""
    parts, rest = [], ERRORS[rule]
    while "{" in rest:
        head, rest = rest.split("{", 1)
        name, rest = rest.split("}", 1)
        parts += [F.lit(head), values[name]]
    return F.concat(*parts, F.lit(rest))


def _error(rule: str, text: Column, condition: Column) -> Column:
    """A list of one error where the condition holds, else an empty one."""
    listed = F.array(F.struct(F.lit(rule).alias("rule"), text.alias("text")))
    return F.filter(listed, lambda e: F.coalesce(condition, F.lit(False)))


def _listed(ids: Column) -> Column:
    return F.array_join(ids, ", ")


def _missing(ids: Column, known: Column) -> Column:
    """Sorted distinct ids that are not known."""
    return F.array_sort(F.array_except(ids, known))


def business_states(claims: Column, approved: Column) -> Column:
    """The claims with ``status`` -- first failing rule of unsupported, classification, unit, sources, value."""
    found = F.transform(claims, lambda c: F.struct(
        c.alias("c"), F.get(F.filter(approved, lambda a: a["metric"] == c["metric"]), F.lit(0)).alias("a")))

    def state(x: Column) -> Column:
        c, a = x["c"], x["a"]
        status = (F.when(a.isNull(), "unsupported")
                  .when(c["classification"] != a["classification"], "classification")
                  .when(c["unit"] != a["unit"], "unit")
                  .when(F.array_sort(F.array_distinct(c["source_ids"])) != a["source_ids"], "sources")
                  .when(~values_match(c["value"], a["value"], c["unit"]), "mismatch").otherwise("match"))
        return F.struct(c["insight_pos"].alias("insight_pos"), c["claim_pos"].alias("claim_pos"), c["metric"].alias("metric"),
                        c["unit"].alias("unit"), c["classification"].alias("classification"),
                        c["value"].cast("decimal(38,6)").alias("value"), status.alias("status"))

    return F.transform(found, state)


def _flat(name: str) -> Column:
    """Claims of all insights in reading order, each with its insight's place."""
    def of(i: Column, at: Column) -> Column:
        return F.transform(i[name], lambda c: F.struct(at.cast("int").alias("insight_pos"), c.alias("c")))

    return F.flatten(F.transform("insights", of))


def figure_states() -> Column:
    """C7 / D16, over rows with ``_figures_claimed`` (``_flat``) and ``figures``: every figure claim with its status."""
    def look(x: Column, at: Column) -> Column:
        c = x["c"]
        before = F.slice("_figures_claimed", F.lit(1), at)
        return F.struct(
            x["insight_pos"].alias("insight_pos"), c.alias("c"),
            F.exists(before, lambda b: (b["c"]["source_id"] == c["source_id"]) & (b["c"]["metric"] == c["metric"])).alias("again"),
            F.get(F.filter("figures", lambda f: (f["source_id"] == c["source_id"]) & (f["metric"] == c["metric"])), F.lit(0)).alias("g"))

    def state(x: Column) -> Column:
        c, g = x["c"], x["g"]
        status = (F.when(x["again"], "duplicate").when(g.isNull(), "unsupported").when(c["unit"] != g["unit"], "wrong_unit")
                  .when(~values_match(c["value"], g["value"], c["unit"]), "mismatch").otherwise("match"))
        return F.struct(x["insight_pos"].alias("insight_pos"), c["source_id"].alias("source_id"), c["metric"].alias("metric"),
                        c["value"].alias("value"), g["value"].alias("grounded_value"), status.alias("status"))

    return F.transform(F.transform("_figures_claimed", look), state)


def validated(briefings: DataFrame) -> DataFrame:
    """Briefings on their knowledge rows with ``errors``, all of them in order, and the lists behind them.

    Takes columns ``claimed_fiscal_year``, ``claimed_fiscal_period``,
    ``source_ids`` and ``insights`` beside the knowledge row.  Adds
    ``figure_states``, ``business_states``, ``unsupported_declared``,
    ``undeclared`` and ``errors`` as an array of (rule, text).
    """
    x = briefings.withColumns({"_figures_claimed": _flat("figure_claims"), "_business_claimed": _flat("business_claims"),
                               "_allowed": KN.allowed_sources()})
    business = F.transform("_business_claimed", lambda b: F.struct(
        b["insight_pos"].alias("insight_pos"), F.lit(0).alias("claim_pos"), *[b["c"][n].alias(n) for n in (
            "metric", "value", "unit", "classification", "source_ids")]))
    approved = F.coalesce(KN.packet_list("approved"), F.filter(F.array(F.struct(
        F.lit("").alias("metric"), F.lit(None).cast("decimal(38,6)").alias("value"), F.lit("").alias("unit"),
        F.lit("").alias("classification"), no_texts().alias("source_ids"))), lambda a: F.lit(False)))
    used = F.array_distinct(F.concat(
        F.flatten(F.transform("insights", lambda i: i["source_ids"])),
        F.transform("_figures_claimed", lambda c: c["c"]["source_id"]),
        F.flatten(F.transform("_business_claimed", lambda c: c["c"]["source_ids"]))))
    x = x.withColumns({"figure_states": figure_states(), "business_states": business_states(business, approved),
                       "unsupported_declared": _missing(F.col("source_ids"), F.col("_allowed")),
                       "undeclared": _missing(used, F.col("source_ids")), "available": KN.available(),
                       "_known": F.coalesce(F.transform(KN.packet_list("explanations"), lambda e: e["explanation_id"]), no_texts())})

    def figure_error(s: Column) -> Column:
        def one(rule: str) -> Column:
            return _error(rule, _text(rule, source=s["source_id"], metric=s["metric"], claimed=plain_decimal(s["value"]),
                                      grounded=F.coalesce(plain_decimal(s["grounded_value"]), F.lit(""))), s["status"] == rule)

        return F.concat(*[one(r) for r in ("duplicate", "unsupported", "wrong_unit", "mismatch")])

    def business_error(s: Column) -> Column:
        return F.concat(*[_error(f"business_{r}", _text(f"business_{r}", metric=s["metric"]), s["status"] == r) for r in (
            "unsupported", "classification", "unit", "sources", "mismatch")])

    def of_insight(i: Column, at: Column) -> Column:
        unsupported = _missing(i["source_ids"], F.col("_allowed"))
        unknown = _missing(i["management_explanation_ids"], F.col("_known"))
        cites = F.size(i["management_explanation_ids"]) > 0
        here = lambda states: F.filter(states, lambda s: s["insight_pos"] == at)
        return F.concat(
            _error("insight_sources", _text("insight_sources", sources=_listed(unsupported)), F.size(unsupported) > 0),
            F.flatten(F.transform(here("figure_states"), figure_error)),
            F.flatten(F.transform(here("business_states"), business_error)),
            _error("no_driver_context", _text("no_driver_context"), cites & ~F.col("available")),
            _error("explanations", _text("explanations", ids=_listed(unknown)), F.col("available") & (F.size(unknown) > 0)))

    slipped = ((F.col("claimed_fiscal_year") != F.col("fiscal_year")) | (F.col("claimed_fiscal_period") != F.col("fiscal_period")))
    errors = F.concat(
        _error("period", _text("period"), slipped),
        _error("declared_sources", _text("declared_sources", sources=_listed(F.col("unsupported_declared"))),
               F.size("unsupported_declared") > 0),
        F.flatten(F.transform("insights", of_insight)),
        _error("undeclared_sources", _text("undeclared_sources", sources=_listed(F.col("undeclared"))), F.size("undeclared") > 0))
    return x.withColumn("errors", errors).drop("_figures_claimed", "_business_claimed", "_allowed", "_known")


def _count(array: str, field: str, *values: str) -> Column:
    return F.size(F.filter(array, lambda e: e[field].isin(*values))).cast("bigint")


def briefing_violations(validated_: DataFrame) -> DataFrame:
    """Every error of every briefing, counted by kind."""
    total = F.size("errors").cast("bigint")
    return validated_.select(
        *DOC, _count("errors", "rule", "period").alias("period_mismatch"),
        F.size("unsupported_declared").cast("bigint").alias("unsupported_declared"),
        _count("errors", "rule", "insight_sources").alias("unsupported_insight_sources"),
        *[_count("errors", "rule", r).alias(n) for r, n in (
            ("duplicate", "duplicate_claims"), ("unsupported", "unsupported_claims"), ("wrong_unit", "unit_errors"),
            ("mismatch", "figure_mismatches"))],
        _count("errors", "rule", *[r for r in ERRORS if r.startswith("business_")]).alias("business_errors"),
        _count("errors", "rule", "no_driver_context", "explanations").alias("explanation_errors"),
        F.size("undeclared").cast("bigint").alias("undeclared_claim_sources"),
        total.alias("total_errors"), (total == 0).alias("valid"))


def briefing_errors(validated_: DataFrame) -> DataFrame:
    """The error texts of every briefing, all of them, in reading order."""
    return validated_.select(*DOC, F.transform("errors", lambda e: e["text"]).alias("errors"))


def contract_failure() -> Column:
    """I2 / D15 over validated briefings: the first failing step, or NULL.

    Drivers available -> six categories exactly once -> every insight has
    sources -> no error of I1.
    """
    return F.when(~F.col("available"), "drivers_unavailable").when(~_categories_ok(), "categories") \
        .when(~_sourced(), "insight_sources").when(F.size("errors") > 0, "claims")


def contract_reason(failure: Column) -> Column:
    """The text of a failing step; of step ``claims`` all error texts in order."""
    chain = F.when(failure == "claims", F.array_join(F.transform("errors", lambda e: e["text"]), " "))
    for step, text in CONTRACT.items():
        chain = chain.when(failure == step, F.lit(text))
    return chain


def _categories_ok() -> Column:
    return F.array_sort(F.transform("insights", lambda i: i["category"])) == F.array(*[F.lit(c) for c in REQUIRED_CATEGORIES])


def _sourced() -> Column:
    return F.forall("insights", lambda i: F.size(i["source_ids"]) > 0)


def briefing_complete(validated_: DataFrame) -> DataFrame:
    """The complete-briefing contract with its first failing step."""
    x = validated_.withColumn("_failure", contract_failure())
    return x.select(*DOC, F.col("available").alias("drivers_available"), _categories_ok().alias("categories_ok"),
                    _sourced().alias("insight_sources_ok"), (F.size("errors") == 0).alias("claims_valid"),
                    F.col("_failure").alias("first_failure"), F.col("_failure").isNull().alias("complete"))
