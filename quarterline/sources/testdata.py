"""Fiscal fact tables derived by Spark from the TPC-H style test tables.

The test tables carry no financial statements, so they are turned into
periodic facts with fixed, additive rules (see FIXTURES.md):

* an *entity* is a supplier nation (default), a supplier or a part;
* the fiscal year ends in June: ``fiscal_year = year + (month >= 7)`` and the
  quarter is ``((month + 5) % 12) div 3 + 1`` of ``l_shipdate``;
* price, discount and tax are exact decimals; the four metrics are sums of
  ``p``, ``p(1-d)``, ``p(1-d-t)`` and the same with returned lines negated,
  scaled by 10000 into BIGINT so every sum is exact and re-aggregatable.

``fx_obs`` turns the quarterly facts into filing observations, including
comparative rows, restatements, ties, cumulative six/nine-month and
full-year values and instants, so the observation pipeline has every case to
decide.  All of it is lazy DataFrame code; the work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarterline.functions.metrics import CONCEPT_OF_METRIC, CORE_METRICS
from quarterline.functions.periods import quarter_end, quarter_start

GRAINS = ("nation", "supplier", "part")

# Fixture rules for observation variants (see FIXTURES.md).
RESTATED_MOD, RESTATED_REM = 5, 0  # entity_id % 5 = 0 -> restatement (+7, filed end+60)
TIE_MOD, TIE_REM = 5, 1  # entity_id % 5 = 1 -> tie (+9, filed end+25)
NO_NINE_MONTH_MOD, NO_NINE_MONTH_YEAR = 7, 1998  # entity_id % 7 = 0 and FY1998 -> no nine-month row
# Observation variants (seq, quarter slot used for the dates).
VARIANTS = [(1, 1), (2, 1), (3, 1), (4, 1),
            (1, 2), (2, 2), (3, 2), (4, 2),
            (1, 3), (2, 3), (3, 3), (4, 3),
            (5, 2), (6, 3), (7, 4), (8, 4)]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _line_measures(li: DataFrame) -> DataFrame:
    """Per line: fiscal year / quarter and the four measures, exact in 1/10000.

    The decimals become whole hundredths first: BIGINT products and sums are
    as exact and far cheaper than those of wide decimals.
    """
    m = F.month("l_shipdate")
    p = (F.col("l_extendedprice").cast("decimal(12,2)") * 100).cast("bigint")
    d = (F.col("l_discount").cast("decimal(4,2)") * 100).cast("bigint")
    t = (F.col("l_tax").cast("decimal(4,2)") * 100).cast("bigint")
    lines = li.select("l_partkey", "l_suppkey", "l_returnflag",
                      (F.year("l_shipdate") + F.when(m >= 7, 1).otherwise(0)).cast("int").alias("fiscal_year"),
                      (F.floor(((m + 5) % 12) / 3) + 1).cast("int").alias("q"), p.alias("p"), d.alias("d"), t.alias("t"))
    p, op = F.col("p"), F.col("p") * (F.lit(100) - F.col("d") - F.col("t"))
    return lines.select(
        "l_partkey", "l_suppkey", "fiscal_year", "q",
        (p * 100).alias("m_revenue"),
        (p * (F.lit(100) - F.col("d"))).alias("m_gross_profit"),
        op.alias("m_operating_income"),
        F.when(F.col("l_returnflag") == "R", -p * 100).otherwise(op).alias("m_net_income"),
    )


def _sums(keys: list[str]) -> list:
    return [F.sum(f"m_{m}").alias(f"m_{m}") for m in CORE_METRICS]


def fx_wide(spark: SparkSession, sf_dir: str, grain: str = "nation") -> DataFrame:
    """Wide quarterly facts: (entity_id, fiscal_year, q, revenue..net_income BIGINT).

    Lines are summed on the key they already carry before any join, so the
    supplier lookup for the nation grain joins per-supplier quarter totals,
    not line items (the sums are exact decimals, so re-aggregating is exact).
    """
    if grain not in GRAINS:
        raise ValueError(f"unknown grain {grain!r}")
    lines = _line_measures(read_table(spark, sf_dir, "lineitem"))
    if grain == "part":
        agg = lines.groupBy(F.col("l_partkey").alias("entity_id"), "fiscal_year", "q").agg(*_sums([]))
    elif grain == "supplier":
        agg = lines.groupBy(F.col("l_suppkey").alias("entity_id"), "fiscal_year", "q").agg(*_sums([]))
    else:
        per_supplier = lines.groupBy("l_suppkey", "fiscal_year", "q").agg(*_sums([]))
        supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        agg = (
            per_supplier.join(supplier, per_supplier.l_suppkey == supplier.s_suppkey)
            .groupBy(F.col("s_nationkey").alias("entity_id"), "fiscal_year", "q")
            .agg(*_sums([]))
        )
    # one shuffle by entity serves every later aggregate and window; an entity has a row per quarter
    return agg.select(
        F.col("entity_id").cast("bigint").alias("entity_id"),
        "fiscal_year",
        "q",
        *[F.col(f"m_{m}").alias(m) for m in CORE_METRICS],
    ).repartition("entity_id")


def fx_long(spark: SparkSession, sf_dir: str, grain: str = "nation", wide: DataFrame | None = None) -> DataFrame:
    """Long fact table in the loaded-table shape (one row per entity, metric, period)."""
    wide = wide if wide is not None else fx_wide(spark, sf_dir, grain)
    # exploded, not unpivoted: an explode keeps the rows' partitioning known
    values = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in CORE_METRICS])
    long = wide.select("entity_id", "fiscal_year", "q", F.explode(values).alias("v")).select("entity_id", "fiscal_year", "q", "v.*")
    concept = F.create_map(*[x for m in CORE_METRICS for x in (F.lit(m), F.lit(CONCEPT_OF_METRIC[m]))])
    start = quarter_start("fiscal_year", "q")
    end = quarter_end("fiscal_year", "q")
    return long.select(
        "entity_id",
        "metric",
        F.element_at(concept, F.col("metric")).alias("sec_metric"),
        start.alias("start_date"),
        end.alias("end_date"),
        "fiscal_year",
        F.concat(F.lit("Q"), F.col("q").cast("string")).alias("fiscal_period"),
        "q",
        F.col("value").cast("bigint").alias("value"),
        F.when(F.col("q") == 4, "DERIVED").otherwise("10-Q").alias("form"),
        F.date_add(end, F.when(F.col("q") == 4, 60).otherwise(25)).alias("filed_date"),
        F.concat_ws("-", F.lit("E"), F.col("entity_id").cast("string"), F.col("fiscal_year").cast("string"),
                    F.col("q").cast("string")).alias("accession_number"),
    )


def fx_segments(spark: SparkSession, sf_dir: str, grain: str = "nation") -> DataFrame:
    """Segment revenue per (entity_id, segment = p_brand, fiscal_year, q).

    The pruned lines are joined to part (and supplier) and then summed once,
    partially before the shuffle.  Summing lines per part and supplier first
    would shuffle every line: almost no two lines share both.
    """
    lines = _line_measures(read_table(spark, sf_dir, "lineitem")).select(
        "l_partkey", "l_suppkey", "fiscal_year", "q", "m_revenue")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    joined = lines.join(part, lines.l_partkey == part.p_partkey)
    if grain == "nation":
        supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        joined = joined.join(supplier, joined.l_suppkey == supplier.s_suppkey)
        entity = F.col("s_nationkey")
    elif grain == "supplier":
        entity = F.col("l_suppkey")
    else:
        entity = F.col("l_partkey")
    return (
        joined.groupBy(entity.cast("bigint").alias("entity_id"), F.col("p_brand").alias("segment"), "fiscal_year", "q")
        .agg(F.sum("m_revenue").alias("revenue")).repartition("entity_id")
    )


def fx_year_values(long: DataFrame) -> DataFrame:
    """(entity_id, metric, fiscal_year, v1..v4): the quarter values of one year."""
    return long.groupBy("entity_id", "metric", "fiscal_year").agg(
        *[F.max(F.when(F.col("q") == k, F.col("value"))).alias(f"v{k}") for k in (1, 2, 3, 4)]
    )


def fx_obs(spark: SparkSession, sf_dir: str, grain: str = "nation", long: DataFrame | None = None) -> DataFrame:
    """Filing observations: (entity_id, concept, unit, seq, start_date, end_date,
    val, accn, fy, fp, form, filed) with dates as ISO text, as in a facts document.

    Variants are produced with a generator over a fixed literal list (no join).
    """
    long = long if long is not None else fx_long(spark, sf_dir, grain)
    year = fx_year_values(long)
    variants = F.array(*[F.struct(F.lit(s).alias("seq"), F.lit(k).alias("k")) for s, k in VARIANTS])
    x = year.select("*", F.explode(variants).alias("v")).select(
        "entity_id", "metric", "fiscal_year", "v1", "v2", "v3", "v4",
        F.col("v.seq").alias("seq"), F.col("v.k").alias("k"),
    )
    seq, k, ent, fy = F.col("seq"), F.col("k"), F.col("entity_id"), F.col("fiscal_year")
    v1, v2, v3, v4 = (F.col(f"v{i}") for i in (1, 2, 3, 4))
    vk = F.when(k == 1, v1).when(k == 2, v2).when(k == 3, v3).otherwise(v4)
    keep = (
        F.when(seq.isin(1, 2), vk.isNotNull())
        .when(seq == 3, vk.isNotNull() & (ent % RESTATED_MOD == RESTATED_REM))
        .when(seq == 4, vk.isNotNull() & (ent % TIE_MOD == TIE_REM))
        .when(seq == 5, v1.isNotNull() & v2.isNotNull())
        .when(seq == 6, v1.isNotNull() & v2.isNotNull() & v3.isNotNull()
              & ~((ent % NO_NINE_MONTH_MOD == 0) & (fy == NO_NINE_MONTH_YEAR)))
        .otherwise(v4.isNotNull())
    )
    start = F.when(seq <= 4, quarter_start(fy, k)).when(seq <= 7, quarter_start(fy, F.lit(1)))
    end = quarter_end(fy, k)
    val = (
        F.when(seq <= 2, vk)
        .when(seq == 3, vk + 7)
        .when(seq == 4, vk + 9)
        .when(seq == 5, v1 + v2)
        .when(seq == 6, v1 + v2 + v3)
        .when(seq == 7, F.coalesce(v1, F.lit(0)) + F.coalesce(v2, F.lit(0)) + F.coalesce(v3, F.lit(0)) + v4)
        .otherwise(v4)
    )
    fp = (
        F.when(seq <= 4, F.concat(F.lit("Q"), k.cast("string")))
        .when(seq == 5, "Q2").when(seq == 6, "Q3").otherwise("FY")
    )
    filed = F.date_add(end, F.when(seq == 2, 390).when(seq.isin(3, 7, 8), 60).otherwise(25))
    concept = F.create_map(*[x for m in CORE_METRICS for x in (F.lit(m), F.lit(CONCEPT_OF_METRIC[m]))])
    return x.where(keep).select(
        "entity_id",
        F.element_at(concept, F.col("metric")).alias("concept"),
        F.lit("USD").alias("unit"),
        seq.cast("int").alias("seq"),
        start.cast("string").alias("start_date"),
        end.cast("string").alias("end_date"),
        val.cast("bigint").alias("val"),
        F.concat_ws("-", F.lit("A"), ent.cast("string"), fy.cast("string"), k.cast("string"),
                    seq.cast("string")).alias("accn"),
        F.when(seq == 2, fy + 1).otherwise(fy).cast("int").alias("fy"),
        fp.alias("fp"),
        F.when(seq >= 7, "10-K").otherwise("10-Q").alias("form"),
        filed.cast("string").alias("filed"),
    )


# Fixture rules for the dirty text copy of the long facts.
NA_MOD, NA_REM, NA_Q = 6, 0, 2  # value 'n/a'
ZERO_MOD, ZERO_REM, ZERO_Q = 6, 1, 3  # value '0'
DUP_MOD, DUP_YEAR, DUP_Q = 4, 1999, 1  # duplicated key
DROP_MOD, DROP_YEAR, DROP_Q, DROP_METRIC = 9, 2000, 3, "gross_profit"  # dropped key
EXTRA_MOD, EXTRA_REM, EXTRA_YEAR, EXTRA_Q = 8, 3, 2000, 1  # unexpected metric 'other_income'
NULL_MOD, NULL_REM, NULL_YEAR, NULL_Q = 10, 2, 2001, 2  # NULL form


def fx_raw(long: DataFrame) -> DataFrame:
    """All-text long facts with the dirt a quality check must find.

    Same columns as the loaded table (entity_id BIGINT, the rest STRING), as
    an all-text CSV scan would give them.  Variants come from a generator.
    """
    x = long.select("*", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("variant"))
    ent, fy, q, metric, var = F.col("entity_id"), F.col("fiscal_year"), F.col("q"), F.col("metric"), F.col("variant")
    keep = (
        F.when(var == 1, ~((ent % DROP_MOD == 0) & (fy == DROP_YEAR) & (q == DROP_Q) & (metric == DROP_METRIC)))
        .when(var == 2, (ent % DUP_MOD == 0) & (fy == DUP_YEAR) & (q == DUP_Q))
        .otherwise((ent % EXTRA_MOD == EXTRA_REM) & (fy == EXTRA_YEAR) & (q == EXTRA_Q) & (metric == "net_income"))
    )
    value = (
        F.when((ent % NA_MOD == NA_REM) & (q == NA_Q), F.lit("n/a"))
        .when((ent % ZERO_MOD == ZERO_REM) & (q == ZERO_Q), F.lit("0"))
        .otherwise(F.col("value").cast("string"))
    )
    form = F.when((var == 1) & (ent % NULL_MOD == NULL_REM) & (fy == NULL_YEAR) & (q == NULL_Q), F.lit(None)) \
        .otherwise(F.col("form"))
    return x.where(keep).select(
        "entity_id",
        F.when(var == 3, F.lit("other_income")).otherwise(metric).alias("metric"),
        "sec_metric",
        F.col("start_date").cast("string").alias("start_date"),
        F.col("end_date").cast("string").alias("end_date"),
        fy.cast("string").alias("fiscal_year"),
        "fiscal_period",
        value.alias("value"),
        form.cast("string").alias("form"),
        F.col("filed_date").cast("string").alias("filed_date"),
        "accession_number",
    )


# Fixture rules for approved business-driver packets.
BROKEN_TOTAL_MOD, BROKEN_TOTAL_REM = 7, 3  # reported revenue off by one dollar
UNKNOWN_SOURCE_MOD, UNKNOWN_SOURCE_REM = 11, 5  # revenue fact cites an unapproved source
OVERRIDE_MOD, OVERRIDE_REM = 13, 4  # product indicator 'revenue' overrides the reported fact
DERIVED_MOD, DERIVED_REM = 17, 2  # a stored derived metric (not allowed)
STALE_SOURCE_MOD, STALE_SOURCE_REM = 19, 6  # metrics source dated one year earlier
# one rule broken per entity, by entity_id % 23
RULE_MOD = 23
BAD_FACT_CLASS, DUP_FACT_SOURCE, BAD_SEG_CLASS, DUP_SEG_SOURCE, BAD_URL, BAD_SOURCE_TYPE, BAD_ATTRIBUTION = 9, 10, 11, 12, 13, 14, 15
DUP_SOURCE, MISSING_FACT, PRIOR_OFF, CHANGE_OFF = 16, 18, 19, 20
NO_EXPLANATIONS, BAD_UNIT, BAD_QUALIFIER = 8, 21, 22
HALF_DOLLAR_MOD, HALF_DOLLAR_REM = 26, 17  # the overriding indicator is not a whole dollar
SOURCE_TYPES = ["press_release", "metrics", "earnings_call"]
URL_PREFIX = "https://investor.example.com/"
ATTRIBUTION = "Entity management"


def _sid(kind: str):
    return F.concat(F.lit("e"), F.col("entity_id").cast("string"), F.lit("-fy"), F.col("fiscal_year").cast("string"),
                    F.lit("-"), F.col("fiscal_period"), F.lit("-" + kind))


def fx_packets(segments: DataFrame) -> DataFrame:
    """Approved packets for every (entity, quarter) whose prior-year quarter exists, one row each.

    ``segments``: revenue per (entity, segment, quarter).  A quarter's segments
    are gathered once (a handful per entity) and the prior year's come from a
    calendar frame over the entity's quarters; no join.
    """
    per = segments.groupBy("entity_id", "fiscal_year", "q").agg(
        F.sum(F.col("revenue").cast("decimal(38,0)")).cast("bigint").alias("revenue"),
        F.map_from_entries(F.collect_list(F.struct("segment", "revenue"))).alias("cur"))
    year_ago = Window.partitionBy("entity_id").orderBy(F.col("fiscal_year") * 4 + F.col("q")).rangeBetween(-4, -4)
    head = per.withColumns({"prior_revenue": F.first("revenue").over(year_ago), "pri": F.first("cur").over(year_ago)}) \
        .where(F.col("pri").isNotNull()).withColumn("fiscal_period", F.concat(F.lit("Q"), F.col("q").cast("string")))
    keys = ["entity_id", "fiscal_year", "fiscal_period"]
    ent, fy = F.col("entity_id"), F.col("fiscal_year")
    broken = lambda rule: ent % RULE_MOD == rule

    def source(kind: str):
        shown = F.when(broken(DUP_SOURCE), "press_release").otherwise(kind) if kind == "metrics" else F.lit(kind)
        prefix = F.when(broken(BAD_URL), "http://elsewhere.example.org/").otherwise(URL_PREFIX) if kind == "metrics" else F.lit(URL_PREFIX)
        stale = F.when(ent % STALE_SOURCE_MOD == STALE_SOURCE_REM, fy - 1).otherwise(fy) if kind == "metrics" else fy
        listed = F.when(broken(BAD_SOURCE_TYPE), "blog").otherwise(kind) if kind == "earnings_call" else F.lit(kind)
        return F.struct(
            F.concat(_sid(""), shown).alias("source_id"), stale.cast("int").alias("source_fiscal_year"),
            F.col("fiscal_period").alias("source_fiscal_period"), listed.alias("source_type"),
            F.concat_ws(" ", F.lit("Entity"), ent.cast("string"), F.concat(F.lit("FY"), fy.cast("string")),
                        F.col("fiscal_period"), F.lit(kind)).alias("title"),
            F.concat(prefix, F.lit("e"), ent.cast("string"), F.lit("/fy"), fy.cast("string"), F.lit("-"),
                     F.lower(F.col("fiscal_period")), F.lit("/" + kind)).alias("url"))

    press, metrics = _sid("press_release"), _sid("metrics")
    increase = F.col("revenue") - F.col("prior_revenue")
    growth = F.round(F.lit(100).cast("decimal(3,0)") * increase.cast("decimal(20,0)")
                     / F.nullif(F.col("prior_revenue").cast("decimal(20,0)"), F.lit(0)), 2)

    def fact(kind, pos, metric, label, value, unit, srcs, keep=None):
        listed = F.when(broken(BAD_FACT_CLASS), "derived").otherwise("reported") if kind == "product_indicator" else F.lit("reported")
        made = F.struct(F.lit(kind).alias("kind"), F.lit(pos).alias("pos"), F.lit(metric).alias("metric"),
                        F.lit(label).alias("label"), value.cast("decimal(38,6)").alias("value"),
                        (F.when(broken(BAD_UNIT), "ratio").otherwise(unit) if unit == "percent" else F.lit(unit)).alias("unit"),
                        listed.alias("classification"), srcs.alias("source_ids"),
                        (F.when(broken(BAD_QUALIFIER), "about").when((ent % 2 == 0) & F.lit(unit == "count"), "more_than")
                         .otherwise("exact") if kind == "product_indicator" else F.lit("exact")).alias("qualifier"))
        return made if keep is None else F.when(keep, made)

    revenue_sources = F.when(ent % UNKNOWN_SOURCE_MOD == UNKNOWN_SOURCE_REM,
                             F.array(press, F.lit("unapproved-source"))).otherwise(F.array(press))
    facts = F.array(
        fact("reported_fact", 0, "revenue", "Revenue",
             F.col("revenue") + F.when(ent % BROKEN_TOTAL_MOD == BROKEN_TOTAL_REM, 1).otherwise(0), "usd", revenue_sources),
        fact("reported_fact", 1, "prior_year_quarter_revenue", "Prior-year-quarter revenue",
             F.col("prior_revenue") + F.when(broken(PRIOR_OFF), 1).otherwise(0), "usd", F.array(press)),
        fact("reported_fact", 2, "revenue_increase", "Revenue increase", increase + F.when(broken(CHANGE_OFF), 1).otherwise(0),
             "usd", F.array(press), ~broken(MISSING_FACT)),
        fact("product_indicator", 0, "revenue_growth_pct", "Revenue growth", growth, "percent",
             F.when(broken(DUP_FACT_SOURCE), F.array(metrics, metrics)).otherwise(F.array(metrics)), growth.isNotNull()),
        fact("product_indicator", 1, "revenue", "Revenue (indicator)", F.col("revenue") + 1000
             + F.when(ent % HALF_DOLLAR_MOD == HALF_DOLLAR_REM, F.lit("0.5").cast("decimal(38,6)")).otherwise(0), "usd",
             F.array(metrics), ent % OVERRIDE_MOD == OVERRIDE_REM),
        # whole millions in the first half of a year
        fact("product_indicator", 2, "active_customers", "Active customers",
             F.when(F.col("q") <= 2, (ent + 1) * 1000000).otherwise(F.col("revenue") % 10000000), "count", F.array(metrics)))
    names = F.array_sort(F.array_distinct(F.concat(F.map_keys("cur"), F.map_keys("pri"))))

    def segment(n):
        cur = F.coalesce(F.element_at("cur", n), F.lit(0)).cast("bigint")
        pri = F.coalesce(F.element_at("pri", n), F.lit(0)).cast("bigint")
        grown = F.when(pri == 0, F.lit(0)).otherwise(F.round(
            F.lit(100).cast("decimal(3,0)") * (cur - pri).cast("decimal(20,0)") / F.nullif(pri, F.lit(0)).cast("decimal(20,0)"), 0))
        return F.struct(n.alias("segment"), cur.alias("current_revenue"), pri.alias("prior_year_revenue"),
                        grown.cast("decimal(38,6)").alias("reported_growth_pct"),
                        F.when(broken(BAD_SEG_CLASS), "derived").otherwise("reported").alias("classification"),
                        F.when(broken(DUP_SEG_SOURCE), F.array(press, press)).otherwise(F.array(press)).alias("source_ids"))

    def explanation(name: str, statement: str):
        who = F.when(broken(BAD_ATTRIBUTION), "Someone else").otherwise(ATTRIBUTION) if name == "pricing" else F.lit(ATTRIBUTION)
        return F.struct(F.lit(name).alias("explanation_id"), F.lit(statement).alias("statement"), who.alias("attribution"),
                        F.lit("management_explanation").alias("classification"), F.array(_sid("earnings_call")).alias("source_ids"))

    return head.select(
        *keys, F.when(ent % DERIVED_MOD == DERIVED_REM, 1).otherwise(0).alias("derived_metric_count"),
        F.array(*[source(k) for k in SOURCE_TYPES]).alias("sources"),
        F.filter(facts, lambda f: f.isNotNull()).alias("facts"), F.transform(names, segment).alias("segments"),
        F.filter(F.array(explanation("demand", "Management said customer demand supported the quarter."),
                         explanation("pricing", "Management said pricing changes affected revenue.")),
                 lambda e: ~broken(NO_EXPLANATIONS)).alias("explanations"))


# Fixture rules for generated briefings.
PERIOD_SLIP_MOD, PERIOD_SLIP_REM = 23, 1  # Q2 briefings claim the previous fiscal year
EXTRA_DECLARED_MOD, EXTRA_DECLARED_REM = 29, 3  # declares a source nobody approved
UNKNOWN_EXPL_MOD, UNKNOWN_EXPL_REM = 31, 4  # cites an unknown management explanation
DUP_CATEGORY_MOD, DUP_CATEGORY_REM = 37, 5  # Q1 briefings repeat a category
ODD_CATEGORY = 17  # by RULE_MOD: Q3 briefings use a category outside the domain
PERTURB_MOD = 3  # claims are perturbed only when (entity_id + fiscal_year) % 3 = 0
FIGURE_METRIC_ORDER = ["revenue", "gross_profit", "operating_income", "net_income", "revenue_qoq_growth_pct",
                       "revenue_yoy_growth_pct", "gross_margin_pct", "operating_margin_pct", "net_margin_pct"]
ROLE_INSIGHT = {"current": 0, "previous": 2, "prior_year": 3, "annual": 4}
INSIGHT_CATEGORIES = ["overall_performance", "primary_drivers", "headwinds", "profitability_context", "attention",
                      "investigate_next"]


def _lit_map(d: dict) -> "F.Column":
    return F.create_map(*[x for k, v in d.items() for x in (F.lit(k), F.lit(v))])


def fx_figure_claims(documents: DataFrame) -> DataFrame:
    """Over rows with ``figures``: ``claims`` restating them, perturbed by key (see ``fx_briefings``), in reading order."""
    ent, fy = F.col("entity_id"), F.col("fiscal_year")
    roles, metrics = _lit_map(ROLE_INSIGHT), _lit_map({m: i for i, m in enumerate(FIGURE_METRIC_ORDER)})
    key = F.when((ent + fy) % PERTURB_MOD == 0, ent * 7 + fy * 3)  # NULL: none is perturbed

    def placed(f):
        ipos, mord = F.element_at(roles, f["role"]), F.element_at(metrics, f["metric"])
        v = F.coalesce((F.col("_key") + ipos * 5 + mord) % 8, F.lit(0))
        return F.struct(ipos.alias("insight_pos"), mord.alias("metric_ord"), v.alias("v"), (f["unit"] == "usd").alias("usd"), f.alias("f"))

    def restated(p):
        f, v, usd = p["f"], p["v"], p["usd"]
        val = f["value"].cast("decimal(38,6)")
        value = (F.when(v == 3, F.when(usd, val + 1).otherwise(val + F.lit("0.01").cast("decimal(38,6)")))
                 .when((v == 4) & ~usd, val + F.lit("0.011").cast("decimal(38,6)")).otherwise(val))

        def claim(copy: int):
            return F.struct(
                p["insight_pos"].alias("insight_pos"), (p["metric_ord"] + copy * 100).cast("int").alias("claim_pos"),
                f["metric"].alias("metric"), value.cast("decimal(38,6)").alias("value"),
                F.when(v == 5, F.when(usd, "percent").otherwise("usd")).otherwise(f["unit"]).alias("unit"),
                F.when(v == 6, F.concat(F.lit("unknown:"), f["period_id"])).otherwise(f["source_id"]).alias("source_id"))

        return F.when(v == 7, F.array(claim(0), claim(1))).otherwise(F.array(claim(0)))

    x = documents.withColumn("_key", key).withColumn("_placed", F.transform("figures", placed))
    return x.withColumn("claims", F.sort_array(F.flatten(F.transform("_placed", restated)))).drop("_key", "_placed")


def fx_business_claims() -> "F.Column":
    """Over rows with ``approved``: business claims restating it, perturbed by key (see ``fx_briefings``)."""
    ent = F.col("entity_id")

    def claim(a, at):
        pos = at + 1
        w = F.when((ent + F.col("fiscal_year")) % PERTURB_MOD == 0, (ent + pos) % 7).otherwise(0)
        return F.struct(
            F.lit(1).alias("insight_pos"), pos.cast("int").alias("claim_pos"),
            F.when(w == 6, F.concat(a["metric"], F.lit(".unknown"))).otherwise(a["metric"]).alias("metric"),
            F.when(w == 5, a["value"] + 1).otherwise(a["value"]).cast("decimal(38,6)").alias("value"),
            F.when(w == 3, F.when(a["unit"] == "percent", "usd").otherwise("percent")).otherwise(a["unit"]).alias("unit"),
            F.when(w == 2, F.when(a["classification"] == "reported", "derived").otherwise("reported"))
            .otherwise(a["classification"]).alias("classification"),
            F.when(w == 4, F.array_union(a["source_ids"], F.array(F.lit("extra-source")))).otherwise(a["source_ids"]).alias("source_ids"))

    return F.transform("approved", claim)


def fx_briefings(knowledge: DataFrame) -> DataFrame:
    """A briefing for every grounded period, beside its knowledge row (``operators.knowledge``).

    Figure claims restate grounded figures with a perturbation chosen by key
    (exact, +1 / +0.01, +0.011, wrong unit, unknown source, duplicate);
    business claims restate approved claims (exact, wrong classification,
    wrong unit, extra source, +1, unknown metric).
    """
    ent, fy = F.col("entity_id"), F.col("fiscal_year")
    no_ids = F.array().cast("array<string>")
    valid = F.coalesce(F.col("packet.valid"), F.lit(False))
    order = F.array(*[F.lit(m) for m in FIGURE_METRIC_ORDER])

    def figure_claim(f, ipos: int):
        mord = F.array_position(order, f["metric"]) - 1
        v = F.when((ent + fy) % PERTURB_MOD == 0, (ent * 7 + fy * 3 + ipos * 5 + mord) % 8).otherwise(0)
        val, usd = f["value"].cast("decimal(38,6)"), f["unit"] == "usd"
        value = (F.when(v == 3, F.when(usd, val + 1).otherwise(val + F.lit("0.01").cast("decimal(38,6)")))
                 .when((v == 4) & ~usd, val + F.lit("0.011").cast("decimal(38,6)")).otherwise(val))
        made = F.struct(f["metric"].alias("metric"), value.cast("decimal(38,6)").alias("value"),
                        F.when(v == 5, F.when(usd, "percent").otherwise("usd")).otherwise(f["unit"]).alias("unit"),
                        F.when(v == 6, F.concat(F.lit("unknown:"), f["period_id"])).otherwise(f["source_id"]).alias("source_id"))
        return F.struct(mord.alias("o"), (v == 7).alias("twice"), made.alias("c"))

    def figure_claims(role: str):
        made = F.array_sort(F.transform(F.filter("figures", lambda f: f["role"] == role),
                                        lambda f: figure_claim(f, ROLE_INSIGHT[role])))
        # repeated claims stand after all others
        return F.transform(F.concat(made, F.filter(made, lambda m: m["twice"])), lambda m: m["c"])

    claims = F.transform(fx_business_claims(), lambda c: F.struct(*[c[n].alias(n) for n in (
        "metric", "value", "unit", "classification", "source_ids")]))
    rows = knowledge.withColumn("approved", F.filter(F.col("packet.approved"), lambda a: F.col("packet.valid")))
    for role in ROLE_INSIGHT:
        rows = rows.withColumn(f"_src_{role}", _first_source(role))
    none_figures = F.slice(figure_claims("current"), 1, 0)
    none_business = F.filter(F.array(F.struct(F.lit("").alias("metric"), F.lit(None).cast("decimal(38,6)").alias("value"),
                                              F.lit("").alias("unit"), F.lit("").alias("classification"), no_ids.alias("source_ids"))),
                             lambda c: F.lit(False))
    packet_src = F.when(valid, F.array(_sid("press_release"), _sid("metrics"))).otherwise(no_ids)

    def one(c: str):
        return F.when(F.col(c).isNotNull(), F.array(F.col(c))).otherwise(no_ids)

    def insight(category, title: str, sources, figures=None, business=None, expl=no_ids):
        return F.struct(
            (F.lit(category) if isinstance(category, str) else category).alias("category"), F.lit(title).alias("title"),
            F.concat(F.lit(f"{title} of entity "), ent.cast("string"), F.lit(" in FY"), fy.cast("string"), F.lit(" "),
                     F.col("fiscal_period"), F.lit(".")).alias("narrative"),
            F.lit("ai_interpretation").alias("classification"), sources.alias("source_ids"),
            (none_figures if figures is None else figures).alias("figure_claims"),
            (none_business if business is None else business).alias("business_claims"),
            expl.alias("management_explanation_ids"))

    expl = F.when(ent % UNKNOWN_EXPL_MOD == UNKNOWN_EXPL_REM,
                  F.array(F.lit("demand"), F.lit("unknown_expl"))).otherwise(F.array(F.lit("demand")))
    last_cat = F.when((ent % DUP_CATEGORY_MOD == DUP_CATEGORY_REM) & (F.col("fiscal_period") == "Q1"), "attention") \
        .when((ent % RULE_MOD == ODD_CATEGORY) & (F.col("fiscal_period") == "Q3"), "outlook").otherwise("investigate_next")
    insights = F.array(
        insight("overall_performance", "Overall performance", one("_src_current"), figure_claims("current")),
        insight("primary_drivers", "Primary drivers", packet_src, business=F.coalesce(claims, none_business)),
        insight("headwinds", "Headwinds", one("_src_previous"), figure_claims("previous")),
        insight("profitability_context", "Profitability", one("_src_prior_year"), figure_claims("prior_year")),
        insight("attention", "Attention", one("_src_annual"), figure_claims("annual")),
        insight(last_cat, "Next steps", one("_src_current"), expl=expl))
    declared = F.concat(
        F.filter(F.array(*[F.col(f"_src_{r}") for r in ROLE_INSIGHT]), lambda x: x.isNotNull()), packet_src,
        F.when(ent % EXTRA_DECLARED_MOD == EXTRA_DECLARED_REM, F.array(F.lit("unknown-declared"))).otherwise(no_ids))
    label = F.concat(F.lit("Entity "), ent.cast("string"), F.lit(" FY"), fy.cast("string"), F.lit(" "), F.col("fiscal_period"))
    return rows.select(
        *knowledge.columns,
        F.when((ent % PERIOD_SLIP_MOD == PERIOD_SLIP_REM) & (F.col("fiscal_period") == "Q2"), fy - 1)
        .otherwise(fy).cast("int").alias("claimed_fiscal_year"),
        F.col("fiscal_period").alias("claimed_fiscal_period"),
        F.concat(label, F.lit(" in brief")).alias("headline"),
        F.concat(F.lit("What the approved sources say about "), label, F.lit(".")).alias("executive_summary"),
        declared.alias("source_ids"), insights.alias("insights"))


# How generated responses are broken, by (entity_id * 5 + fiscal_year * 3 + quarter) % 23; others are whole.
RESPONSE_MOD = 23
RESPONSE_FAULTS = ["none", "truncated", "wrong_type", "unknown_field", "missing_headline", "wrong_period", "long_title",
                   "boolean_value", "empty_summary", "duplicate_source", "no_insights", "list", "odd_claim_field"]


def fx_responses(briefings: DataFrame) -> DataFrame:
    """The briefings as provider response texts (``response``) beside their knowledge rows, some broken by key."""
    def period(fy):
        return F.struct(fy.alias("fiscal_year"), F.col("claimed_fiscal_period").alias("fiscal_period"))

    def amounts(claims):
        return F.transform(claims, lambda c: c.withField("value", c["value"].cast("string")))

    insights = F.transform("insights", lambda i: i.withField("figure_claims", amounts(i["figure_claims"]))
                           .withField("business_claims", amounts(i["business_claims"])))
    text = F.to_json(F.struct(
        F.lit("1.0").alias("schema_version"), F.concat(F.lit("Entity "), F.col("entity_id").cast("string")).alias("entity"),
        period(F.col("claimed_fiscal_year")).alias("reporting_period"), "headline", "executive_summary",
        insights.alias("insights"), "source_ids"))
    k = (F.col("entity_id") * 5 + F.col("fiscal_year") * 3 + F.substring("fiscal_period", 2, 1).cast("int")) % RESPONSE_MOD
    fault = F.element_at(F.array(*[F.lit(f) for f in RESPONSE_FAULTS]), F.when(k < len(RESPONSE_FAULTS), k + 1).otherwise(1).cast("int"))
    kept = [c for c in briefings.columns if c not in ("claimed_fiscal_year", "claimed_fiscal_period", "headline",
                                                      "executive_summary", "source_ids", "insights")]
    x = briefings.withColumns({"_text": text, "_fault": F.when(k == len(RESPONSE_FAULTS), "no_text").otherwise(fault)})
    t, f = F.col("_text"), F.col("_fault")
    broken = (
        F.when(f == "no_text", F.lit(None).cast("string"))
        .when(f == "truncated", F.substring(t, 1, 90))
        .when(f == "wrong_type", F.regexp_replace(t, r'"fiscal_year":(\d+)', '"fiscal_year":"$1"'))
        .when(f == "unknown_field", F.regexp_replace(t, r"^\{", '{"reviewer_note":"draft",'))
        .when(f == "missing_headline", F.regexp_replace(t, '"headline":"[^"]*",', ""))
        .when(f == "wrong_period", F.regexp_replace(t, r'"fiscal_year":\d+', F.concat(F.lit('"fiscal_year":'), (F.col("claimed_fiscal_year") - 1).cast("string"))))
        .when(f == "long_title", F.regexp_replace(t, '"title":"Headwinds"', F.concat(F.lit('"title":"'), F.repeat(F.lit("x"), 81), F.lit('"'))))
        .when(f == "boolean_value", F.regexp_replace(t, '"metric":"revenue","value":"[^"]*"', '"metric":"revenue","value":true'))
        .when(f == "empty_summary", F.regexp_replace(t, '"executive_summary":"[^"]*"', '"executive_summary":"  "'))
        .when(f == "duplicate_source", F.regexp_replace(t, r'"source_ids":\["([^"]*)"([^\]]*)\]\}$', '"source_ids":["$1","$1"$2]}'))
        .when(f == "no_insights", F.regexp_replace(t, r'"insights":.*\],"source_ids":(\[[^\]]*\])\}$', '"insights":[],"source_ids":$1}'))
        .when(f == "list", F.concat(F.lit("["), t, F.lit("]")))
        .when(f == "odd_claim_field", F.regexp_replace(t, '"category":"overall_performance"', '"category":"overall_performance","mood":"fine"'))
        .otherwise(t))
    return x.select(*kept, broken.alias("response"))


def _first_source(role: str):
    return F.get(F.filter("figures", lambda f: f["role"] == role), F.lit(0))["source_id"]


# The question bank (routed questions, an unsupported one, blank and too long).
QUESTION_BANK = [
    "What does revenue mean?",
    "What is the difference between QoQ and YoY?",
    "Did the company perform well?",
    "What drove the company's growth?",
    "What was the main headwind?",
    "Are the company's margins strong?",
    "What should I investigate next?",
    "Explain this quarter like I do not know finance.",
    "What is the main headwind?",
    "How will the share price move next year?",
    "   ",
    "x" * 501,
    "Should I buy the stock?",
]
SESSION_ENTITIES = 25  # sessions are spread over the 25 nation entities by conv_id % 25
# Appended phrases that exercise the advice filter, by doc_id % 10.
ADVICE_PHRASES = {0: " We recommend you buy shares.", 1: " Our forecast is strong.", 2: " This is a holding pattern.",
                  3: " Price targets were raised.", 4: " Reinvestment continued."}


def fx_questions(conversations: DataFrame, latest: DataFrame) -> DataFrame:
    """User turns of ``conversations`` as questions about each entity's latest grounded quarter.

    Every user turn asks its own text.  Generated sessions (negative ids) ask
    the question bank at the same turns, so that every route occurs.
    ``latest``: one row per entity, its latest grounded quarter with whatever
    is known about it; a question whose entity has none keeps NULL columns.
    """
    bank = F.array(*[F.lit(q) for q in QUESTION_BANK])
    idx = ((F.col("conv_id") * 7 + F.col("turn")) % len(QUESTION_BANK) + 1).cast("int")
    asked = F.array(F.struct(F.col("conv_id").alias("session_id"), F.col("text").alias("question")),
                    F.struct((-F.col("conv_id") - 1).alias("session_id"), F.element_at(bank, idx).alias("question")))
    q = conversations.where(F.col("role") == "user").select(
        F.col("turn").cast("int").alias("turn"), (F.col("conv_id") % SESSION_ENTITIES).cast("bigint").alias("entity_id"),
        F.explode(asked).alias("a")).select("a.session_id", "turn", "a.question", "entity_id")
    return q.join(latest, "entity_id", "left")


def fx_exchanges(conversations: DataFrame) -> DataFrame:
    """Answered user turns: (session_id, turn, question, answer), the answer being the next turn's text."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    x = conversations.select("conv_id", "turn", "role", "text", F.lead("role").over(w).alias("next_role"),
                             F.lead("text").over(w).alias("answer"))
    return x.where((F.col("role") == "user") & (F.col("next_role") == "assistant")).select(
        F.col("conv_id").alias("session_id"), F.col("turn").cast("int").alias("turn"),
        F.col("text").alias("question"), "answer")


def fx_advice_text(documents: DataFrame) -> DataFrame:
    """Documents with a phrase appended by ``doc_id % 10`` (some prohibited, some near misses)."""
    phrase = F.element_at(F.create_map(*[x for k, v in ADVICE_PHRASES.items() for x in (F.lit(k), F.lit(v))]),
                          (F.col("doc_id") % 10).cast("int"))
    return documents.select("doc_id", F.concat(F.col("text"), F.coalesce(phrase, F.lit(""))).alias("text"))


# Texts of generated provider answers beside their main text.
ADVICE_EXPLANATION = "The forecast is that revenue grows."
PLAIN_EXPLANATION = "Revenue is what customers paid."
ADVICE_AREA = "price targets of analysts"
PLAIN_AREA = "margin direction"


def fx_answers(requests: DataFrame) -> DataFrame:
    """Provider answers for every row, beside its knowledge row; without text where the period is not grounded.

    Claims restate the current revenue and net margin and cite the packet's
    'demand' explanation, perturbed by ``(session_id + turn) % 6``; other texts
    and the claimed period are perturbed by ``abs(session_id) + turn``.
    """
    current = F.filter("figures", lambda f: f["role"] == "current")
    r = requests.withColumn("_src", F.get(current, F.lit(0))["source_id"])
    for m in ("revenue", "net_margin_pct"):
        r = r.withColumn(f"_{m}", _value_of(m))
    p = (F.col("session_id") + F.col("turn")) % 6
    k = F.abs("session_id") + F.col("turn")
    call = _sid("earnings_call")

    def claim(metric, cls, value, unit, srcs, expl):
        return F.struct(F.lit(metric).alias("metric"), cls.alias("classification"),
                        value.cast("decimal(38,6)").alias("value"), unit.cast("string").alias("unit"),
                        srcs.alias("source_ids"), expl.cast("string").alias("management_explanation_id"))

    claims = F.array(
        claim("revenue", F.when(p == 2, "derived_metric").when(p == 4, "ai_interpretation").otherwise("reported_fact"),
              F.when(p == 1, F.col("_revenue") + 1).otherwise(F.col("_revenue")), F.when(p == 5, "percent").otherwise("usd"),
              F.when(p == 3, F.array(F.lit("unknown:source"))).otherwise(F.array(F.col("_src"))), F.lit(None)),
        claim("net_margin_pct", F.lit("derived_metric"),
              F.col("_net_margin_pct") + F.lit("0.01").cast("decimal(38,6)"), F.lit("percent"), F.array(F.col("_src")), F.lit(None)),
        claim("demand", F.lit("management_explanation"), F.lit(None), F.lit(None), F.array(call), F.lit("demand")))
    text = F.when(p % 2 == 0, F.lit("Revenue was reported, and management cited demand."))\
        .otherwise(F.lit("Revenue grew; we recommend you buy."))
    return r.select(
        *requests.columns, F.lit("supported").alias("answer_status"),
        (F.col("fiscal_year") - (k % 13 == 0).cast("int")).alias("claimed_fiscal_year"),
        F.col("fiscal_period").alias("claimed_fiscal_period"), F.when(F.col("_src").isNotNull(), text).alias("answer_text"),
        F.when(k % 7 == 0, F.lit(ADVICE_EXPLANATION)).when(k % 7 != 1, F.lit(PLAIN_EXPLANATION)).alias("explanation"),
        F.when(k % 11 == 0, F.array(F.lit(PLAIN_AREA), F.lit(ADVICE_AREA))).otherwise(F.array(F.lit(PLAIN_AREA))).alias("areas"),
        claims.alias("claims"),
        F.array_distinct(F.flatten(F.transform(claims, lambda c: c["source_ids"]))).alias("answer_sources"))


def _value_of(metric: str):
    return F.get(F.filter("figures", lambda f: (f["role"] == "current") & (f["metric"] == metric)), F.lit(0))["value"]
