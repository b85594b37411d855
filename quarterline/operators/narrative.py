"""Deterministic narrative: KPI text, margin direction, insights, plain-English takeaways.

Everything is a column expression over rows that already carry the facts
(analytics rows, grounding contexts, rankings), joined on the entity /
period key -- one bulk pass for every entity and period, no UDFs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterline.functions import formatting as fmt
from quarterline.functions.arrays import each
from quarterline.functions.periods import fiscal_label
from quarterline.operators import knowledge as KN

ENTITY = "entity_id"
PERIOD = [ENTITY, "fiscal_year", "fiscal_period"]
# Margin labels, the steady threshold and narrative texts.
MARGIN_LABELS = {"gross_margin_pct": "gross", "operating_margin_pct": "operating", "net_margin_pct": "net"}
STEADY_THRESHOLD = 0.05
STRONG_MOMENTUM = "Revenue increased compared with both the prior quarter and the same quarter last year."
SOME_MOMENTUM = "Revenue increased compared with the {comparison}."
WEAK_MOMENTUM = "Approved growth measures do not show broad positive revenue momentum."
PROFITABILITY_TEXT = "Profitability remained strong, with a healthy share of revenue retained as profit."
HEADLINES = {"strong": "{name} had a strong quarter.", "some": "{name} reported positive revenue momentum.",
             "other": "{name}’s latest quarter requires a closer look."}
TAKEAWAYS = {
    "largest_contributor": "{segment} was the largest positive segment contributor.",
    "secondary_contributor": "{segment} was the second positive contributor.",
    "principal_headwind": "{segment} was the segment headwind.",
    "positive_signal": "{product} was a major positive product signal.",
    "negative_signal": "{product} were negative product signals.",
}
NET_MARGIN_STRONG = 20
VISIBLE_PRIORITY = ["revenue_momentum", "largest_contributor", "principal_headwind", "profitability",
                    "management_context"]
# Signal rules for product indicators (metric -> rule) and the explanation shown as context.
POSITIVE_SIGNAL_METRICS = ["revenue_growth_pct"]
NEGATIVE_SIGNAL_METRICS = ["revenue_growth_pct"]
CONTEXT_EXPLANATION_ID = "pricing"


def entity_label(entity: Column | str = ENTITY) -> Column:
    e = F.col(entity) if isinstance(entity, str) else entity
    return F.concat(F.lit("Entity "), e.cast("string"))


def kpis(latest: DataFrame) -> DataFrame:
    """Formatted KPI tiles for each entity's latest quarter."""
    return latest.select(
        *PERIOD,
        fiscal_label("fiscal_year", "fiscal_period").alias("period_label"),
        fmt.format_billions("revenue").alias("revenue_text"),
        fmt.format_billions("net_income").alias("net_income_text"),
        fmt.format_percent("revenue_qoq_growth_pct", include_sign=True).alias("qoq_text"),
        fmt.format_percent("revenue_yoy_growth_pct", include_sign=True).alias("yoy_text"),
        fmt.format_percent("gross_margin_pct").alias("gross_margin_text"),
        fmt.format_percent("operating_margin_pct").alias("operating_margin_text"),
        fmt.format_percent("net_margin_pct").alias("net_margin_text"),
        fmt.direction_word("revenue_qoq_change").alias("qoq_direction"),
        fmt.direction_word("revenue_yoy_change").alias("yoy_direction"),
        fmt.tone("revenue_yoy_growth_pct").alias("yoy_tone"),
    )


def with_previous_margins(analytics: DataFrame) -> DataFrame:
    """Previous row's margins by position (the row before in chronological order)."""
    w = Window.partitionBy(ENTITY).orderBy("fiscal_year", "quarter_number")
    return analytics.select("*", *[F.lag(m, 1).over(w).alias(f"prev_{m}") for m in MARGIN_LABELS])


def _direction(m: str) -> Column:
    change = F.col(m).cast("double") - F.col(f"prev_{m}").cast("double")
    return F.when(F.col(m).isNull() | F.col(f"prev_{m}").isNull(), F.lit(None)) \
        .when(F.abs(change) < STEADY_THRESHOLD, "held steady").when(change > 0, "improved").otherwise("declined")


def margin_directions(analytics: DataFrame) -> DataFrame:
    """(entity, period, margin, direction) for every row with a previous row."""
    x = with_previous_margins(analytics)
    arr = F.array(*[F.struct(F.lit(label).alias("margin"), _direction(m).alias("direction"))
                    for m, label in MARGIN_LABELS.items()])
    return (x.select(*PERIOD, F.explode(arr).alias("d")).where(F.col("d.direction").isNotNull())
            .select(*PERIOD, "d.margin", "d.direction"))


def _margin_sentence() -> Column:
    parts = F.filter(F.array(*[
        F.when(_direction(m).isNotNull(), F.concat(F.lit(label + " margin "), _direction(m)))
        for m, label in MARGIN_LABELS.items()]), lambda x: x.isNotNull())
    n = F.size(parts)
    head = F.array_join(F.slice(parts, 1, F.greatest(n - 1, F.lit(1))), ", ")
    last = F.element_at(parts, -1)
    return (F.when(n == 0, F.lit(None))
            .when(n == 1, F.concat(fmt.capitalize(last), F.lit(".")))
            .otherwise(F.concat(fmt.capitalize(head), F.lit(", and "), last, F.lit(" versus the prior quarter."))))


def _growth(value: str, comparison: str) -> Column:
    v = F.col(value)
    return F.when(v.isNull(), F.lit(f"Revenue growth {comparison} was unavailable")).otherwise(
        F.concat(F.lit("revenue "), fmt.direction_word(v), F.lit(" "), fmt.format_percent(F.abs(v)),
                 F.lit(" " + comparison)))


def insight_array() -> Column:
    """H2 over analytics rows with previous margins: scale, growth, profitability and margin-direction insights."""
    period = fiscal_label("fiscal_year", "fiscal_period")
    items = F.array(
        F.struct(F.lit(0).alias("pos"), F.lit("Current scale").alias("title"),
                 F.concat(entity_label(), F.lit(" reported "), fmt.format_billions("revenue"),
                          F.lit(" in revenue for "), period, F.lit(".")).alias("body")),
        F.struct(F.lit(1).alias("pos"), F.lit("Growth momentum").alias("title"),
                 F.concat(fmt.capitalize(_growth("revenue_yoy_growth_pct", "year over year")), F.lit(" and "),
                          _growth("revenue_qoq_growth_pct", "from the prior quarter"), F.lit(".")).alias("body")),
        F.struct(F.lit(2).alias("pos"), F.lit("Profitability").alias("title"),
                 F.concat(F.lit("Gross margin was "), fmt.format_percent("gross_margin_pct"),
                          F.lit(", operating margin was "), fmt.format_percent("operating_margin_pct"),
                          F.lit(", and net margin was "), fmt.format_percent("net_margin_pct"), F.lit("."))
                 .alias("body")),
        F.struct(F.lit(3).alias("pos"), F.lit("What deserves attention").alias("title"),
                 _margin_sentence().alias("body")),
    )
    return F.filter(items, lambda i: i["body"].isNotNull())


def executive_insights(analytics: DataFrame) -> DataFrame:
    """H2: insights of each entity's latest quarter, as (entity, period, pos, title, body) rows."""
    x = with_previous_margins(analytics)
    w = Window.partitionBy(ENTITY).orderBy(F.col("fiscal_year").desc(), F.col("quarter_number").desc())
    latest = x.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
    return latest.select(*PERIOD, each(insight_array()).alias("i")).select(*PERIOD, "i.pos", "i.title", "i.body")


def _signal_label(metric: str, sign: int) -> Column:
    """The product an indicator speaks of, when its last record has the sign; else NULL."""
    found = F.try_element_at(F.filter("_indicators", lambda f: f["metric"] == metric), F.lit(-1))
    return F.when(F.signum(found["value"]) == sign, F.split(found["label"], " growth").getItem(0))


def _named(text: str, **values: Column) -> Column:
    """The text with its braced values in place; NULL if one is."""
    parts, rest = [], text
    while "{" in rest:
        head, rest = rest.split("{", 1)
        name, rest = rest.split("}", 1)
        parts += [F.lit(head), values[name]]
    return F.concat(*parts, F.lit(rest))


def with_summary(knowledge: DataFrame) -> DataFrame:
    """Knowledge rows with ``headline``, ordered ``takeaways`` and the sorted sources of both.

    Also ``pos1``, ``pos2`` and ``neg1``, the leading segments of an available
    packet.  Every takeaway names the sources it rests on: the figures' for
    momentum and profitability, the packet's for all others.
    """
    has = KN.available()
    none = F.lit(None).cast("string")

    def segment(side: str, at: int) -> Column:
        return F.when(has, F.get(F.col(f"packet.{side}"), F.lit(at))["segment"]).otherwise(none)

    x = knowledge.withColumns({
        "pos1": segment("positive", 0), "pos2": segment("positive", 1), "neg1": segment("negative", 0),
        "_indicators": F.filter(KN.packet_list("facts"), lambda f: f["kind"] == "product_indicator"),
        "_context": F.get(F.filter(KN.packet_list("explanations"),
                                   lambda e: e["explanation_id"] == CONTEXT_EXPLANATION_ID), F.lit(0))["statement"],
        "source_ids": F.array_sort(KN.allowed_sources()), "_figure_sources": F.array_sort(KN.figure_sources())})
    negative = F.array_join(F.filter(F.array(*[_signal_label(m, -1) for m in NEGATIVE_SIGNAL_METRICS]), lambda n: n.isNotNull()), " and ")
    positive = F.coalesce(*[_signal_label(m, 1) for m in POSITIVE_SIGNAL_METRICS])
    x = x.withColumns({"_positive": positive, "_negative": F.when(negative != "", negative)})
    qoq, yoy = F.col("revenue_qoq_growth_pct"), F.col("revenue_yoy_growth_pct")
    strong = F.coalesce((qoq > 0) & (yoy > 0), F.lit(False))
    some = F.coalesce(qoq > 0, F.lit(False)) | F.coalesce(yoy > 0, F.lit(False))
    name = entity_label()
    headline = F.when(strong, _named(HEADLINES["strong"], name=name)).when(some, _named(HEADLINES["some"], name=name)) \
        .otherwise(_named(HEADLINES["other"], name=name))
    comparison = F.when(F.coalesce(qoq > 0, F.lit(False)), "prior quarter").otherwise("same quarter last year")
    momentum = F.when(strong, F.lit(STRONG_MOMENTUM)).when(some, _named(SOME_MOMENTUM, comparison=comparison)) \
        .otherwise(F.lit(WEAK_MOMENTUM))
    rules = [
        ("revenue_momentum", momentum),
        ("largest_contributor", _named(TAKEAWAYS["largest_contributor"], segment=F.col("pos1"))),
        ("secondary_contributor", _named(TAKEAWAYS["secondary_contributor"], segment=F.col("pos2"))),
        ("principal_headwind", _named(TAKEAWAYS["principal_headwind"], segment=F.col("neg1"))),
        ("positive_signal", _named(TAKEAWAYS["positive_signal"], product=F.col("_positive"))),
        ("negative_signal", _named(TAKEAWAYS["negative_signal"], product=F.col("_negative"))),
        ("management_context", F.col("_context")),
        ("profitability", F.when(F.col("net_margin_pct") >= NET_MARGIN_STRONG, F.lit(PROFITABILITY_TEXT))),
    ]
    on_figures = ("revenue_momentum", "profitability")
    items = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(category).alias("category"), text.alias("text"),
                               (F.col("_figure_sources") if category in on_figures
                                else F.array_sort(F.array_except("source_ids", "_figure_sources"))).alias("source_ids"))
                      for i, (category, text) in enumerate(rules)])
    return x.withColumns({"headline": headline, "takeaways": F.filter(items, lambda t: t["text"].isNotNull())}) \
        .drop("_indicators", "_context", "_positive", "_negative", "_figure_sources")


def plain_english(summaries: DataFrame) -> DataFrame:
    """H3: headline and ordered takeaways per grounded period, one row per takeaway."""
    x = summaries.select(*PERIOD, "headline", each("takeaways").alias("t"))
    return x.select(*PERIOD, "headline", "t.pos", "t.category", "t.text")


def visible_takeaways(takeaways: DataFrame, limit: int = 4) -> DataFrame:
    """the first ``limit`` takeaways by fixed category priority."""
    prio = F.array_position(F.array(*[F.lit(c) for c in VISIBLE_PRIORITY]), F.col("category"))
    w = Window.partitionBy(*PERIOD).orderBy("_prio")
    x = takeaways.withColumn("_prio", prio).where(F.col("_prio") > 0)
    return (x.withColumn("visible_rank", F.row_number().over(w)).where(F.col("visible_rank") <= limit)
            .select(*PERIOD, "visible_rank", "category", "text"))


# Presentation priority of product signals and management explanations.
PRIORITY_SIGNAL_METRICS = ["revenue_growth_pct", "revenue", "active_customers"]
PRIORITY_EXPLANATION_IDS = ["demand", "pricing"]


def driver_presentation(packets: DataFrame) -> DataFrame:
    """Contributors, headwinds, signals (priority order), explanations
    and sources of every valid packet as (period, section, pos, label, value, tone) rows.

    ``packets``: packets in force (``knowledge.packets_in_force``).
    """
    def item(section: str, pos: Column, label: Column, value: Column, tone: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), pos.cast("int").alias("pos"), label.alias("label"),
                        value.alias("value"), tone.alias("tone"))

    def ranked(side: str, section: str) -> Column:
        return F.transform(side, lambda c, i: item(section, i + 1, c["segment"], F.concat(
            fmt.signed_billions(c["absolute_revenue_change"]), F.lit(" | "), fmt.percent_2dp(c["share"])), F.lit(side)))

    def prioritised(found, ids: list[str]) -> Column:
        made = F.array(*[F.struct(F.lit(i + 1).alias("pos"), found(x).alias("r")) for i, x in enumerate(ids)])
        return F.filter(made, lambda m: m["r"].isNotNull())

    def signal(metric: str) -> Column:
        return F.try_element_at(F.filter("facts", lambda f: (f["kind"] == "product_indicator") & (f["metric"] == metric)), F.lit(-1))

    def explanation(name: str) -> Column:
        return F.get(F.filter("explanations", lambda e: e["explanation_id"] == name), F.lit(0))

    def signal_item(m: Column) -> Column:
        f = m["r"]
        shown = (F.when(f["unit"] == "percent", fmt.signed_percent(f["value"])).when(f["unit"] == "usd", fmt.signed_billions(f["value"]))
                 .when(f["unit"] == "count", fmt.count_text(f["value"], f["qualifier"])).otherwise(fmt.trim_decimal(f["value"])))
        return item("signal", m["pos"], f["label"], shown,
                    F.when(f["unit"] == "percent", fmt.tone(f["value"])).otherwise(F.lit("neutral")))

    x = packets.withColumns({"_signals": prioritised(signal, PRIORITY_SIGNAL_METRICS),
                             "_explained": prioritised(explanation, PRIORITY_EXPLANATION_IDS),
                             "_sources": F.array_sort(F.transform("sources", lambda s: F.struct(
                                 s["source_id"].alias("source_id"), s["title"].alias("title"), s["url"].alias("url"))))})
    neutral = F.lit("neutral")
    items = F.concat(
        ranked("positive", "contributor"), ranked("negative", "headwind"), F.transform("_signals", signal_item),
        F.transform("_explained", lambda m: item("explanation", m["pos"], m["r"]["attribution"], m["r"]["statement"], neutral)),
        F.transform("_sources", lambda s, i: item("source", i + 1, s["title"], s["url"], neutral)))
    shown = F.filter(items, lambda i: F.col("valid"))
    return x.select(*PERIOD, each(shown).alias("i")).select(*PERIOD, "i.*")


def quarterly_report_table(quarterly: DataFrame) -> DataFrame:
    """Presentation projection of the quarterly facts with formatted values."""
    return quarterly.select(
        ENTITY, fiscal_label("fiscal_year").alias("Fiscal year"), F.col("fiscal_period").alias("Quarter"),
        *[fmt.format_billions(m).alias(label) for m, label in (
            ("revenue", "Revenue"), ("gross_profit", "Gross profit"), ("operating_income", "Operating income"),
            ("net_income", "Net income"))])


def report_table(annual: DataFrame) -> DataFrame:
    """Presentation projection of the annual frame with formatted values."""
    return annual.select(
        ENTITY, fiscal_label("fiscal_year").alias("Fiscal year"),
        fmt.format_billions("revenue").alias("Revenue"),
        fmt.format_percent("revenue_yoy_growth_pct").alias("Revenue growth"),
        fmt.format_billions("gross_profit").alias("Gross profit"),
        fmt.format_billions("operating_income").alias("Operating income"),
        fmt.format_billions("net_income").alias("Net income"),
        fmt.format_percent("gross_margin_pct").alias("Gross margin"),
        fmt.format_percent("operating_margin_pct").alias("Operating margin"),
        fmt.format_percent("net_margin_pct").alias("Net margin"),
    )
