"""Bulk question answering: normalise, gate, route, answer, quota, history, safety.

A *question table* (session, turn, question, plus the grounded period it is
asked about) is answered in one pass: the ordered routing cascade is a single
``when`` chain over the normalised text, deterministic answers join the
period's plain-English summary and driver ranking, and per-session quota /
history are window frames over the session's turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterline.functions.arrays import each, no_texts
from quarterline.operators import knowledge as KN
from quarterline.operators.claims import values_match

PERIOD = ["entity_id", "fiscal_year", "fiscal_period"]
TURN = ["session_id", "turn"]
# Limits and messages.
MAX_QUESTION_LENGTH = 500
MAX_PROVIDER_QUESTIONS = 5
MAX_HISTORY_TURNS = 3
LENGTH_MESSAGE = "Questions must contain between 1 and 500 characters."
QUOTA_MESSAGE = "This session has reached the five-question grounded Q&A limit."
UNSUPPORTED_MESSAGE = ("Live grounded Q&A is not enabled yet. I can currently explain the displayed metrics, "
                       "performance, approved drivers, headwinds, and areas to investigate.")
NO_DRIVERS = ("Approved financial data shows the change in revenue, but approved driver context is unavailable "
              "for this period.")
NO_HEADWIND = "No approved segment headwind is available for this period."
DRIVERS_START = "The largest approved positive segment contributors were "
HEADWIND_START = "The main approved segment headwind was "
INVESTIGATE_START = "Useful next areas to investigate are "
INVESTIGATE_AREAS = ["revenue growth durability", "margin direction"]
NO_CONTEXT_MESSAGE = "No approved financial context is available for this question."
SAFE_FAILURE_MESSAGE = "The grounded answer could not be validated."
MAX_SESSION_TURNS = 20
MARGIN_DEFAULT = "The displayed margins show how much revenue remained at each stage of profitability."
# Glossary definitions and aliases.
DEFINITIONS = {
    "Revenue": "The total money generated from sales before expenses.",
    "Gross profit": "Revenue left after the direct costs of delivering products and services.",
    "Operating income": "Profit from the core business after operating expenses.",
    "Net income": "Profit remaining after all expenses, interest, and taxes.",
    "QoQ growth": "How a result changed compared with the immediately preceding quarter.",
    "YoY growth": "How a result changed compared with the same quarter one year earlier.",
    "Gross margin": "The share of revenue left after direct delivery costs.",
    "Operating margin": "The share of revenue left after core operating expenses.",
    "Net margin": "How much profit the company kept from every dollar of revenue.",
    "Segment contribution": "How much one business segment added to or reduced the company’s total change.",
    "Headwind": "A business area or condition that reduced growth or profitability.",
}
ALIASES = {
    "revenue": "Revenue",
    "gross profit": "Gross profit",
    "operating income": "Operating income",
    "net income": "Net income",
    "qoq": "QoQ growth",
    "quarter over quarter": "QoQ growth",
    "yoy": "YoY growth",
    "year over year": "YoY growth",
    "gross margin": "Gross margin",
    "operating margin": "Operating margin",
    "net margin": "Net margin",
    "segment contribution": "Segment contribution",
    "headwind": "Headwind",
}
GLOSSARY_TRIGGERS = ["mean", "what is", "explain", "definition"]
# Trigger phrases of the routes, in routing order.
PERFORMANCE_PHRASES = ["perform well", "strong quarter"]
EXPLAIN_PHRASES = ["explain this quarter", "plain english", "do not know finance"]
DRIVER_PHRASES = ["drove", "drivers", "growth"]
MARGIN_PHRASES = ["strong", "profit", "healthy"]
# Whole words that an answer may not use.
ADVICE_PATTERN = r"(buy|sell|hold|price targets?|investment advice|invest|forecasts?|recommendations?)"


def normalize(question: Column) -> Column:
    """Lower, runs of non-[a-z0-9] -> one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(question), "[^a-z0-9]+", " "))


def stripped_length(question: Column) -> Column:
    """H6: length after stripping surrounding whitespace (all of it, not just spaces)."""
    return F.length(F.regexp_replace(question, r"^\s+|\s+$", ""))


def _any(text: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | text.contains(w)
    return out


def glossary_label(norm: Column) -> Column:
    """H5: the glossary entry the question asks for (longest alias first), or NULL."""
    chain = None
    for alias in sorted(ALIASES, key=lambda a: -len(a)):
        cond = norm.contains(alias)
        chain = F.when(cond, F.lit(ALIASES[alias])) if chain is None else chain.when(cond, F.lit(ALIASES[alias]))
    return F.when(_any(norm, GLOSSARY_TRIGGERS), chain)


def glossary_answer(norm: Column) -> Column:
    diff = norm.contains("difference") & norm.contains("qoq") & norm.contains("yoy")
    label = glossary_label(norm)
    defs = F.create_map(*[x for k, v in DEFINITIONS.items() for x in (F.lit(k), F.lit(v))])
    return (F.when(diff, F.lit(f"QoQ: {DEFINITIONS['QoQ growth']} YoY: {DEFINITIONS['YoY growth']}"))
            .when(label.isNotNull(), F.concat(label, F.lit(": "), F.element_at(defs, label))))


def route(norm: Column, glossary: Column | None = None) -> Column:
    """H4: glossary -> performance -> explain -> drivers -> headwind -> margin -> investigate -> none."""
    return (
        F.when((glossary_answer(norm) if glossary is None else glossary).isNotNull(), "glossary")
        .when(_any(norm, PERFORMANCE_PHRASES), "performance")
        .when(_any(norm, EXPLAIN_PHRASES), "explain")
        .when(_any(norm, DRIVER_PHRASES) & ~norm.contains("mean"), "drivers")
        .when(norm.contains("headwind"), "headwind")
        .when(norm.contains("margin") & _any(norm, MARGIN_PHRASES), "margin")
        .when(norm.contains("investigate") | norm.contains("attention"), "investigate")
        .otherwise("none")
    )


def latest(summaries: DataFrame) -> DataFrame:
    """Per entity the latest grounded quarter with all its columns, in one aggregate."""
    rest = [c for c in summaries.columns if c != "entity_id"]
    found = summaries.groupBy("entity_id").agg(F.max_by(F.struct(*rest), F.struct("fiscal_year", "fiscal_period")).alias("k"))
    return found.select("entity_id", "k.*")


def answer(questions: DataFrame, provider_enabled: bool = True) -> DataFrame:
    """H8 (+ H4-H6, E11, D13): mode, answer text and sources for every question.

    ``questions``: session_id, turn, question and the summary of the period
    asked about (``narrative.with_summary``; NULL where there is none).  All
    columns stay; the glossary names no sources, every other deterministic
    answer those of the summary.
    """
    # each step is a column of its own, so no expression is evaluated (or compiled) twice
    x = (questions.withColumn("normalized", normalize(F.col("question"))).withColumn("question_length", stripped_length(F.col("question")))
         .withColumn("_glossary", glossary_answer(F.col("normalized"))).withColumn("_route", route(F.col("normalized"), F.col("_glossary"))))
    length, r = F.col("question_length"), F.col("_route")
    length_ok = F.coalesce((length >= 1) & (length <= MAX_QUESTION_LENGTH), F.lit(False))
    points = F.transform("takeaways", lambda t: t["text"])
    drivers_text = F.when(F.col("pos1").isNull(), F.lit(NO_DRIVERS)).otherwise(
        F.concat(F.lit(DRIVERS_START), F.concat_ws(" and ", F.col("pos1"), F.col("pos2")), F.lit(".")))
    headwind_text = F.when(F.col("neg1").isNull(), F.lit(NO_HEADWIND)).otherwise(
        F.concat(F.lit(HEADWIND_START), F.col("neg1"), F.lit(".")))
    areas = F.concat_ws(", ", *[F.lit(a) for a in INVESTIGATE_AREAS], F.concat(F.lit("the "), F.col("neg1"), F.lit(" headwind")))
    profitability = F.get(F.filter(points, lambda t: t.startswith("Profitability")), F.lit(0))
    deterministic = (
        F.when(r == "glossary", F.col("_glossary"))
        .when(r == "performance", F.concat_ws(" ", F.col("headline"), F.get(points, F.lit(0))))
        .when(r == "explain", F.concat_ws(" ", F.col("headline"), F.array_join(points, " ")))
        .when(r == "drivers", drivers_text)
        .when(r == "headwind", headwind_text)
        .when(r == "margin", F.coalesce(profitability, F.lit(MARGIN_DEFAULT)))
        .when(r == "investigate", F.concat(F.lit(INVESTIGATE_START), areas, F.lit(".")))
    )
    grounded = F.col("fiscal_year").isNotNull()
    x = x.withColumn("provider_eligible", length_ok & grounded & (r == "none") & F.lit(provider_enabled))
    w = Window.partitionBy("session_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    eligible = F.col("provider_eligible")
    x = x.withColumn("provider_used_before", F.coalesce(F.sum(eligible.cast("int")).over(w), F.lit(0)).cast("int"))
    over = eligible & (F.col("provider_used_before") >= MAX_PROVIDER_QUESTIONS)
    mode = (F.when(~length_ok | ~grounded, "insufficient_context").when(r != "none", "deterministic")
            .when(~F.lit(provider_enabled), "insufficient_context")
            .when(over, "insufficient_context").otherwise("provider_request"))
    text = (F.when(~length_ok, F.lit(LENGTH_MESSAGE)).when(~grounded, F.lit(NO_CONTEXT_MESSAGE))
            .when(r != "none", deterministic)
            .when(~F.lit(provider_enabled), F.lit(UNSUPPORTED_MESSAGE))
            .when(over, F.lit(QUOTA_MESSAGE)))
    x = x.withColumns({"route": F.when(length_ok & grounded, r), "mode": mode, "answer": text})
    named = (F.col("mode") == "deterministic") & (F.col("route") != "glossary")
    return x.withColumn("sources_named", F.when(named, F.col("source_ids")).otherwise(no_texts())).drop("_glossary", "_route")


ANSWER_COLUMNS = [*TURN, *PERIOD, "normalized", "question_length", "route", "provider_eligible", "provider_used_before", "mode",
                  "answer"]


def history(turns: DataFrame, exchanges: DataFrame) -> DataFrame:
    """Per asked turn, the last three answered exchanges before it, as prompt history.

    ``turns``: session_id, turn.  ``exchanges``: session_id, turn, question,
    answer.  A store of the latest ``MAX_SESSION_TURNS`` at the time of asking
    always holds those three, so no exchange is left out for its session's length.
    """
    exchange = F.struct("turn", "question", "answer")
    near = Window.partitionBy("session_id").orderBy("turn", "question", "answer").rowsBetween(1 - MAX_HISTORY_TURNS, 0)
    ended = exchanges.select(*TURN, F.struct(exchange.alias("_at"), F.collect_list(exchange).over(near).alias("_h")).alias("_last"))
    both = turns.select(*TURN, F.lit(True).alias("_asked")).unionByName(ended.withColumn("_asked", F.lit(False)), allowMissingColumns=True)
    before = Window.partitionBy("session_id").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    found = both.withColumn("_last", F.max("_last").over(before)).where("_asked")
    return found.select(*TURN, F.coalesce(F.col("_last._h"), F.array().cast(ended.schema["_last"].dataType["_h"].dataType)).alias("history"))


def final_modes(answered: DataFrame) -> DataFrame:
    """The outcome per question once provider answers are checked.

    A request whose answer is approved and supported is ``grounded_ai`` with
    that answer and its sources; any other request fails safely.
    ``answered``: answered questions with the checked provider answer of their
    request beside them (errors, answer_status, answer_text, answer_sources;
    NULL where none came back).
    """
    asked = F.col("mode") == "provider_request"
    good = asked & F.coalesce((F.size("errors") == 0) & F.col("answer_text").isNotNull(), F.lit(False))
    supported = good & (F.col("answer_status") == "supported")
    return answered.select(
        *TURN, F.when(supported, "grounded_ai").when(asked, "insufficient_context").otherwise(F.col("mode")).alias("mode"),
        F.when(good, F.col("answer_text")).when(asked, F.lit(SAFE_FAILURE_MESSAGE)).otherwise(F.col("answer")).alias("message"),
        asked.alias("provider_request_made"),
        F.when(good, F.col("answer_sources")).when(asked, no_texts()).otherwise(F.col("sources_named")).alias("source_ids"))


def advice_flag(text: Column) -> Column:
    """H7: prohibited advice / forecast words, whole words, case-insensitive.

    Word boundaries are written as explicit Unicode letter/digit classes so
    accented neighbours count as word characters.
    """
    return text.rlike(r"(?i)(^|[^\p{L}\p{N}_])" + ADVICE_PATTERN + r"([^\p{L}\p{N}_]|$)")


CORE = ["revenue", "gross_profit", "operating_income", "net_income"]
# Error texts of answers, in the order of the checks.
ANSWER_ERRORS = {
    "period": "Answer reporting period does not match approved context.",
    "sources": "Answer contains an unsupported source ID.",
    "advice": "Answer contains prohibited investment or forecast language.",
}
CLAIM_ERRORS = {
    "unsupported_source": "Unsupported claim source for {metric}.",
    "unsupported_management": "Unsupported or unattributed management explanation.",
    "mismatch": "Unsupported or mismatched claim: {metric}.",
}


def claim_states(answers: DataFrame) -> DataFrame:
    """Answers on their knowledge rows with ``claim_states`` (claim_pos, metric, classification, status).

    Allowed sources first; management claims need a known, attributed
    explanation; numeric claims match a grounded figure cited by the claim
    (first in context order) or else an approved business claim.
    """
    x = answers.withColumns({
        "_allowed": KN.allowed_sources(), "_approved": KN.packet_list("approved"), "_explained": KN.packet_list("explanations"),
        "_attributed": F.lower("answer_text").contains("management")})

    def look(c: Column, at: Column) -> Column:
        return F.struct(
            at.cast("int").alias("claim_pos"), c.alias("c"), F.array_sort(F.array_distinct(c["source_ids"])).alias("s"),
            F.get(F.filter("figures", lambda f: (f["metric"] == c["metric"]) & F.array_contains(c["source_ids"], f["source_id"])),
                  F.lit(0)).alias("f"),
            F.get(F.filter("_approved", lambda a: a["metric"] == c["metric"]), F.lit(0)).alias("a"),
            F.get(F.filter("_explained", lambda e: e["explanation_id"] == c["management_explanation_id"]), F.lit(0)).alias("e"))

    def state(x: Column) -> Column:
        c, f, a, e, cls = x["c"], x["f"], x["a"], x["e"], x["c"]["classification"]

        def fits(expected: Column, found: Column) -> Column:
            return F.coalesce(cls.isin("ai_interpretation") | (cls == expected), F.lit(False)) \
                & F.coalesce((c["unit"] == found["unit"]) & values_match(c["value"], found["value"], c["unit"]), F.lit(False))

        managed = F.coalesce(e.isNotNull() & (c["metric"] == e["explanation_id"])
                             & (x["s"] == F.array_sort(F.array_distinct(e["source_ids"]))) & F.col("_attributed"), F.lit(False))
        by_figure = fits(F.when(c["metric"].isin(*CORE), "reported_fact").otherwise("derived_metric"), f)
        by_claim = fits(F.when(a["classification"] == "reported", "reported_fact").otherwise("derived_metric"), a) & (x["s"] == a["source_ids"])
        status = (F.when(F.size(F.array_except(c["source_ids"], "_allowed")) > 0, "unsupported_source")
                  .when(cls == "management_explanation", F.when(managed, "match").otherwise("unsupported_management"))
                  .when(f.isNotNull(), F.when(by_figure, "match").otherwise("mismatch"))
                  .when(a.isNotNull(), F.when(F.coalesce(by_claim, F.lit(False)), "match").otherwise("mismatch"))
                  .otherwise("unsupported"))
        return F.struct(x["claim_pos"].alias("claim_pos"), c["metric"].alias("metric"), cls.alias("classification"), status.alias("status"))

    return x.withColumn("claim_states", F.transform(F.transform("claims", look), state)).drop("_approved", "_explained", "_attributed")


def answer_claim_status(answers: DataFrame) -> DataFrame:
    """C13 / I3 claim rules, one row per claim."""
    x = claim_states(answers).select(*TURN, *PERIOD, each("claim_states").alias("s"))
    return x.select(*TURN, "s.claim_pos", *PERIOD, "s.metric", "s.classification", "s.status")


def validated_answers(answers: DataFrame) -> DataFrame:
    """Answers with ``errors`` as (rule, text) in order: period, sources, advice, then claim by claim.

    Advice is looked for in answer, explanation and suggested areas together.
    """
    x = claim_states(answers)
    narrative = F.concat_ws(" ", "answer_text", "explanation", "areas")
    slipped = (F.col("claimed_fiscal_year") != F.col("fiscal_year")) | (F.col("claimed_fiscal_period") != F.col("fiscal_period"))
    breaks = {"period": slipped, "sources": F.size(F.array_except("answer_sources", "_allowed")) > 0, "advice": advice_flag(narrative)}
    heads = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(ANSWER_ERRORS[r]).alias("text"),
                               F.coalesce(broken, F.lit(False)).alias("on")) for r, broken in breaks.items()])

    def text(s: Column) -> Column:
        def named(rule: str) -> Column:
            head, _, tail = CLAIM_ERRORS[rule].partition("{metric}")
            return F.concat(F.lit(head), s["metric"], F.lit(tail)) if tail else F.lit(head)

        return (F.when(s["status"] == "unsupported_source", named("unsupported_source"))
                .when(s["status"] == "unsupported_management", named("unsupported_management")).otherwise(named("mismatch")))

    claims = F.transform(F.filter("claim_states", lambda s: s["status"] != "match"),
                         lambda s: F.struct(F.lit("claim").alias("rule"), text(s).alias("text")))
    kept = F.transform(F.filter(heads, lambda h: h["on"]), lambda h: F.struct(h["rule"].alias("rule"), h["text"].alias("text")))
    return x.withColumn("errors", F.concat(kept, claims)).drop("_allowed")


def answer_violations(validated: DataFrame) -> DataFrame:
    """Per answer -- period, unsupported declared sources, advice language, claim errors."""
    def count(rule: str) -> Column:
        return F.size(F.filter("errors", lambda e: e["rule"] == rule)).cast("bigint")

    total = F.size("errors").cast("bigint")
    return validated.select(*TURN, *PERIOD, count("period").alias("period_mismatch"), count("sources").alias("unsupported_sources"),
                            count("advice").alias("advice_language"), count("claim").alias("claim_errors"),
                            total.alias("total_errors"), (total == 0).alias("approved"))


def source_labels(answers: DataFrame) -> DataFrame:
    """``title (id)`` per cited source (id alone when unknown), in citation order.

    ``answers``: on their knowledge rows, with ``answer_sources``.
    """
    def label(sid: Column) -> Column:
        known = F.get(F.filter(F.col("packet.sources"), lambda s: s["source_id"] == sid), F.lit(0))["title"]
        return F.when(known.isNotNull(), F.concat(known, F.lit(" ("), sid, F.lit(")"))).otherwise(sid)

    return answers.select(*TURN, F.array_join(F.transform("answer_sources", label), ", ").alias("source_labels"),
                          F.size("answer_sources").cast("bigint").alias("sources"))
