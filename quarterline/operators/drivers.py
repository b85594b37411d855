"""Approved business-driver packets: checks, reconciliation, contributions, ranking.

A packet is one row keyed by ``(entity_id, fiscal_year, fiscal_period)`` with
its records in arrays: ``sources``, ``facts`` (reported facts and product
indicators, with ``kind``), ``segments`` and ``explanations``.  The arrays hold
one filing's records, so every rule is an expression over one row: no packet
check joins or shuffles anything.  Sums are exact (DECIMAL); the contribution
share is rounded HALF_UP to 2 places.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterline.functions.arrays import each, each_with_pos

PACKET = ["entity_id", "fiscal_year", "fiscal_period"]
RECORDS = ["sources", "facts", "segments", "explanations"]
# Facts every packet must report, and the rule messages in check order.
REQUIRED_FACTS = ["revenue", "prior_year_quarter_revenue", "revenue_increase"]
RULES = [
    ("duplicate_sources", "Approved packet contains duplicate source IDs."),
    ("source_period", "Official source reporting period does not match packet."),
    ("unsupported_sources", "Unsupported source IDs in packet records."),
    ("derived_stored", "Approved packet must not store computed segment metrics; derive them at load time."),
    ("missing_facts", "Approved packet is missing required company facts."),
    ("current_mismatch", "Segment current revenue does not reconcile to company revenue."),
    ("prior_mismatch", "Segment prior-year revenue does not reconcile to company prior-year revenue."),
    ("change_mismatch", "Segment revenue changes do not reconcile exactly."),
]
SOURCE_TYPES = ["press_release", "metrics", "earnings_call"]
FACT_UNITS = ["usd", "percent", "count"]
FACT_QUALIFIERS = ["exact", "more_than"]
SCHEMA_VERSION = "1.0"

def nest(tables: dict[str, DataFrame]) -> DataFrame:
    """Child tables (``head``, ``sources``, ``facts``, ``segments``, ``explanations``) to packet rows, in one aggregate."""
    order = {"sources": ["source_id"], "facts": ["kind", "pos"], "segments": ["segment"], "explanations": ["explanation_id"]}
    parts = [tables["head"].select(*PACKET, F.lit(True).alias("_head"), "derived_metric_count")]
    for name in RECORDS:
        rows = tables[name]
        # 'reported_fact' comes before 'product_indicator'
        keys = [F.col(c) == "product_indicator" if c == "kind" else F.col(c) for c in order[name]]
        fields = [c for c in rows.columns if c not in PACKET]
        parts.append(rows.select(*PACKET, F.struct(F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)]).alias("k"),
                                                   F.struct(*fields).alias("r")).alias(name)))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    found = rows.groupBy(*PACKET).agg(F.max("_head").alias("_head"), F.max("derived_metric_count").alias("derived_metric_count"),
                                      *[F.collect_list(n).alias(n) for n in RECORDS])
    return found.where("_head").select(*PACKET, "derived_metric_count",
                                       *[F.transform(F.array_sort(n), lambda x: x["r"]).alias(n) for n in RECORDS])


def child(packets: DataFrame, name: str) -> DataFrame:
    """One child table of the packets."""
    return packets.select(*PACKET, each(name).alias("_r")).select(*PACKET, "_r.*")


def _records() -> Column:
    """Every record that cites sources, as ``(record_kind, record_key, source_ids)``."""
    def cited(name: str, kind: str | None, key: str) -> Column:
        return F.transform(name, lambda r: F.struct((r["kind"] if kind is None else F.lit(kind)).alias("record_kind"),
                                                    r[key].alias("record_key"), r["source_ids"].alias("source_ids")))

    return F.concat(cited("facts", None, "metric"), cited("segments", "segment_result", "segment"),
                    cited("explanations", "management_explanation", "explanation_id"))


def _cited_unapproved() -> Column:
    """A record cites a source that is not approved; the lists alone, without their records."""
    cited = F.concat(*[F.flatten(f"{n}.source_ids") for n in ("facts", "segments", "explanations")])
    return F.exists(cited, lambda s: ~F.array_contains("sources.source_id", s))


def _orphans() -> Column:
    approved = F.transform("sources", lambda s: s["source_id"])
    return F.flatten(F.transform(_records(), lambda r: F.transform(
        F.filter(r["source_ids"], lambda s: ~F.array_contains(approved, s)),
        lambda s: F.struct(r["record_kind"].alias("record_kind"), r["record_key"].alias("record_key"), s.alias("source_id")))))


def orphan_sources(packets: DataFrame) -> DataFrame:
    """Source IDs cited by a record but not approved in the packet."""
    return packets.select(*PACKET, each(_orphans()).alias("o")).select(*PACKET, "o.*")


def last_fact(metric: str, kind: str = "reported_fact") -> Column:
    """The packet's last record of a metric, or NULL."""
    return F.try_element_at(F.filter("facts", lambda f: (f["kind"] == kind) & (f["metric"] == metric)), F.lit(-1))


def _total(name: str, value) -> Column:
    return F.aggregate(name, F.lit(0).cast("decimal(38,0)"), lambda a, r: (a + value(r).cast("decimal(38,0)")).cast("decimal(38,0)"))


def checked(packets: DataFrame) -> DataFrame:
    """``packets`` with segment totals, reported figures and one flag per rule (D12); ``valid`` when none holds."""
    ids = F.col("sources.source_id")
    out = packets.select(
        "*", _total("segments", lambda s: s["current_revenue"]).alias("current_total"),
        _total("segments", lambda s: s["prior_year_revenue"]).alias("prior_total"),
        _total("segments", lambda s: s["current_revenue"] - s["prior_year_revenue"]).alias("change_total"),
        *[last_fact(m)["value"].alias(f"_{m}") for m in REQUIRED_FACTS])
    # a packet without segments has no totals to reconcile
    out = out.withColumns({c: F.when(F.size("segments") > 0, F.col(c)) for c in ("current_total", "prior_total", "change_total")})
    missing = reduce(lambda a, b: a | b, [F.col(f"_{m}").isNull() for m in REQUIRED_FACTS])

    def off(total: str, metric: str) -> Column:
        return ~missing & ~F.coalesce(F.col(total) == F.col(f"_{metric}"), F.lit(False))

    flags = {
        "duplicate_sources": F.size(ids) != F.size(F.array_distinct(ids)),
        "source_period": F.exists("sources", lambda s: (s["source_fiscal_year"] != F.col("fiscal_year"))
                                  | (s["source_fiscal_period"] != F.col("fiscal_period"))),
        "unsupported_sources": _cited_unapproved(),
        "derived_stored": F.col("derived_metric_count") > 0,
        "missing_facts": missing,
        "current_mismatch": off("current_total", "revenue"),
        "prior_mismatch": off("prior_total", "prior_year_quarter_revenue"),
        "change_mismatch": off("change_total", "revenue_increase"),
    }
    out = out.withColumns({n: F.coalesce(c, F.lit(False)) for n, c in flags.items()})
    messages = [F.when(F.col(name), F.lit(msg)) for name, msg in RULES]
    return out.withColumns({
        "violations": F.concat_ws(" ", *messages), "first_violation": F.coalesce(*messages),
        "reported_revenue": F.col("_revenue").cast("bigint"), "reported_increase": F.col("_revenue_increase").cast("bigint"),
    }).withColumn("valid", F.col("first_violation").isNull()).drop(*[f"_{m}" for m in REQUIRED_FACTS])


def reconciliation(packets: DataFrame) -> DataFrame:
    """Per packet, segment totals vs the reported company facts, plus every rule flag."""
    return checked(packets).select(
        *PACKET, *[F.col(c).cast("bigint").alias(c) for c in ("current_total", "prior_total", "change_total")],
        "reported_revenue", "reported_increase", *[name for name, _ in RULES], "violations", "first_violation", "valid")


# Record rules of I6: (name, records, condition that breaks the rule).
def _record_rules(url_prefix: str, attribution: str) -> list[tuple[str, str, object]]:
    def repeated(r: Column) -> Column:
        return F.size(r["source_ids"]) != F.size(F.array_distinct(r["source_ids"]))

    def text(c: Column) -> Column:
        return F.coalesce(F.length(F.trim(c)) > 0, F.lit(False))

    return [
        ("bad_classification", "facts", lambda f: f["classification"] != "reported"),
        ("non_integer_value", "facts", lambda f: f["unit"].isin("usd", "count") & (f["value"] != F.floor(f["value"]))),
        ("bad_source_list", "facts", lambda f: repeated(f) | (F.size(f["source_ids"]) == 0)),
        ("seg_bad_classification", "segments", lambda s: s["classification"] != "reported"),
        ("seg_bad_source_list", "segments", repeated),
        ("bad_url", "sources", lambda s: ~s["url"].startswith(url_prefix)),
        ("bad_source_type", "sources", lambda s: ~s["source_type"].isin(*SOURCE_TYPES)),
        ("bad_explanation", "explanations", lambda e: (e["attribution"] != attribution)
         | (e["classification"] != "management_explanation")),
        ("bad_unit", "facts", lambda f: ~f["unit"].isin(*FACT_UNITS)),
        ("bad_qualifier", "facts", lambda f: ~f["qualifier"].isin(*FACT_QUALIFIERS)),
        ("missing_value", "facts", lambda f: f["value"].isNull() | ~text(f["label"])),
        ("seg_non_integer", "segments", lambda s: (s["current_revenue"] != F.floor(s["current_revenue"]))
         | (s["prior_year_revenue"] != F.floor(s["prior_year_revenue"]))),
    ]


def schema_violations(packets: DataFrame, url_prefix: str, attribution: str) -> DataFrame:
    """Record-level rules per packet, counted by rule.

    classification literals, integral USD / count values (also of segments),
    duplicate source IDs inside a record, official URL prefix, source-type and
    unit domains, qualifier, attribution; ``empty_records`` counts the record
    lists without a member and ``bad_version`` flags another schema version.
    """
    def broken_records(records: str, broken) -> Column:
        return F.size(F.filter(records, lambda r: F.coalesce(broken(r), F.lit(False))))

    def of_kind(kind: str) -> Column:
        return F.size(F.filter("facts", lambda f: f["kind"] == kind))

    counts = {name: broken_records(records, broken) for name, records, broken in _record_rules(url_prefix, attribution)}
    lists = [F.size("sources"), F.size("segments"), F.size("explanations"), of_kind("reported_fact"), of_kind("product_indicator")]
    counts["empty_records"] = reduce(lambda a, b: a + b, [(n == 0).cast("int") for n in lists])
    if "schema_version" in packets.columns:
        counts["bad_version"] = (~F.coalesce(F.col("schema_version") == SCHEMA_VERSION, F.lit(False))).cast("int")
    out = packets.select(*PACKET, *[c.cast("bigint").alias(n) for n, c in counts.items()])
    return out.withColumn("violations", reduce(lambda a, b: a + b, [F.col(n) for n in counts]))


def contribution_array() -> Column:
    """Over checked packets: each segment's change and share; empty unless the packet is valid and its change divisible.

    Share = change * 100 / total (the reported increase), HALF_UP to 2 places.
    """
    def one(s: Column) -> Column:
        change = s["current_revenue"].cast("bigint") - s["prior_year_revenue"].cast("bigint")
        share = F.round(change.cast("decimal(20,0)") * F.lit(100).cast("decimal(3,0)")
                        / F.nullif(F.col("reported_increase").cast("decimal(20,0)"), F.lit(0)), 2)
        return F.struct(s["segment"].alias("segment"), change.alias("absolute_revenue_change"),
                        share.alias("share"), s["source_ids"].alias("source_ids"))

    usable = F.col("valid") & (F.col("reported_increase") != 0)
    made = F.transform("segments", one)
    return F.when(usable, made).otherwise(F.filter(made, lambda c: F.lit(False)))


def contributions(packets: DataFrame) -> DataFrame:
    """Each segment's change and its share of the total change, for valid packets."""
    x = checked(packets).select(*PACKET, each(contribution_array()).alias("c"))
    return x.select(*PACKET, "c.segment", "c.absolute_revenue_change", F.col("c.share").cast("double").alias("contribution_pct"),
                    F.lit("derived").alias("classification"), "c.source_ids")


def ranked_array(contribs: Column, positive: bool) -> Column:
    """The contributions of one sign in rank order: largest change first, then by name."""
    change = "absolute_revenue_change"
    kept = F.filter(contribs, lambda c: (c[change] > 0) if positive else (c[change] < 0))
    keyed = F.transform(kept, lambda c: F.struct((-c[change] if positive else c[change]).alias("k"), c["segment"].alias("segment"),
                                                 c.alias("c")))
    return F.transform(F.array_sort(keyed), lambda k: k["c"])


def ranking(packets: DataFrame) -> DataFrame:
    """Positives by change desc then name; negatives by change asc then name; zero in neither."""
    made = checked(packets).select(*PACKET, contribution_array().alias("_c"))
    sides = F.array(*[F.struct(F.lit(n).alias("direction"), ranked_array(F.col("_c"), n == "positive").alias("items"))
                      for n in ("positive", "negative")])
    x = made.select(*PACKET, each(sides).alias("s")).select(*PACKET, "s.direction", each_with_pos("s.items", "pos", "c"))
    return x.select(*PACKET, "direction", "c.segment", "c.absolute_revenue_change",
                    F.col("c.share").cast("double").alias("contribution_pct"), (F.col("pos") + 1).alias("rank"))


def segment_slug(segment: Column) -> Column:
    """Lower, '&' -> 'and', whitespace runs -> '_' (leading/trailing dropped)."""
    s = F.replace(F.lower(segment), F.lit("&"), F.lit("and"))
    s = F.regexp_replace(s, r"^\s+|\s+$", "")
    return F.regexp_replace(s, r"\s+", "_")


def segment_metric(segment: Column, metric: str) -> Column:
    return F.concat(F.lit("segment."), segment_slug(segment), F.lit("." + metric))


def approved_array() -> Column:
    """G3, over checked packets: all approved business claims, later ones after those they override.

    Reported facts, product indicators, segment results, derived
    contributions, each by record position.  Empty unless ``valid``.
    ``last_by_metric`` keeps the ones in force.
    """
    def entry(metric: Column, value: Column, unit: Column | str, classification: str, sources: Column) -> Column:
        return F.struct(metric.alias("metric"), value.cast("decimal(38,6)").alias("value"),
                        (F.lit(unit) if isinstance(unit, str) else unit).alias("unit"),
                        F.lit(classification).alias("classification"),
                        F.array_sort(F.array_distinct(sources)).alias("source_ids"))

    def of_segment(s: Column) -> Column:
        return F.array(*[entry(segment_metric(s["segment"], m), s[m], u, "reported", s["source_ids"]) for m, u in (
            ("current_revenue", "usd"), ("prior_year_revenue", "usd"), ("reported_growth_pct", "percent"))])

    def of_contribution(c: Column) -> Column:
        return F.array(entry(segment_metric(c["segment"], "absolute_revenue_change"), c["absolute_revenue_change"], "usd",
                             "derived", c["source_ids"]),
                       entry(segment_metric(c["segment"], "contribution_pct"), c["share"], "percent", "derived", c["source_ids"]))

    entries = F.concat(F.transform("facts", lambda f: entry(f["metric"], f["value"], f["unit"], "reported", f["source_ids"])),
                       F.flatten(F.transform("segments", of_segment)),
                       F.flatten(F.transform("contributions", of_contribution)))
    return F.filter(entries, lambda e: F.col("valid"))


def last_by_metric(entries: Column) -> Column:
    """The last entry of every metric, by metric (``entries`` is best a column of its own)."""
    names = F.array_sort(F.array_distinct(F.transform(entries, lambda e: e["metric"])))
    return F.transform(names, lambda m: F.try_element_at(F.filter(entries, lambda e: e["metric"] == m), F.lit(-1)))
