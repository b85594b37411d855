"""As-of grounding facts for every eligible (entity, quarter) at once.

* eligible period: exactly one analytics row for the key and all four core
  metrics present (window count over the key -- the analytics frame is
  already partitioned by entity, so no extra exchange);
* previous / prior-year quarter by **calendar** key ``4*fy + q`` using range
  frames ``rangeBetween(-1,-1)`` / ``(-4,-4)`` over the entity window -- an
  exact lookup without a self-join;
* annual context as of the quarter (no look-ahead): the latest complete year
  ``<= fy`` for Q4 and ``<= fy-1`` otherwise.  Periods and annual rows are
  unioned into one ordered stream per entity and ``last(ignorenulls)``
  carries the latest annual row forward -- no range join, no pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterline.functions.metrics import CORE_METRICS
from quarterline.functions.periods import period_identifier, quarter_number

ENTITY = "entity_id"
PERIOD = [ENTITY, "fiscal_year", "fiscal_period"]
# Metric sets per grounding role and the percent-valued metrics.
PERIOD_METRICS = [*CORE_METRICS, "revenue_qoq_growth_pct", "revenue_yoy_growth_pct",
                  "gross_margin_pct", "operating_margin_pct", "net_margin_pct"]
COMPARISON_METRICS = [*CORE_METRICS, "gross_margin_pct", "operating_margin_pct", "net_margin_pct"]
ANNUAL_METRICS = [*CORE_METRICS, "revenue_yoy_growth_pct", "gross_margin_pct", "operating_margin_pct",
                  "net_margin_pct"]
PERCENT_METRICS = ["revenue_qoq_growth_pct", "revenue_yoy_growth_pct", "gross_margin_pct",
                   "operating_margin_pct", "net_margin_pct"]
ROLES = ["current", "previous", "prior_year", "annual"]
QUARTER_DATASET = "quarterly_analytics"
ANNUAL_DATASET = "annual_financials"


def _all_core_present() -> Column:
    ok = F.lit(True)
    for m in CORE_METRICS:
        ok = ok & F.col(m).isNotNull()
    return ok


def eligible_periods(analytics: DataFrame) -> DataFrame:
    """Rows whose key occurs once and whose core metrics are all present."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*PERIOD))
    return (analytics.withColumn("_n", n).where((F.col("_n") == 1) & _all_core_present()).drop("_n")
            .withColumn("period_index", F.col("fiscal_year") * 4 + quarter_number("fiscal_period")))


def _metrics_struct(metrics: list[str], with_period: bool = True) -> Column:
    head = [F.col("fiscal_year").alias("fiscal_year")]
    if with_period:
        head.append(F.col("fiscal_period").alias("fiscal_period"))
    return F.struct(*head, *[F.col(m).cast("decimal(38,6)").alias(m) for m in metrics])


def with_neighbors(eligible: DataFrame) -> DataFrame:
    """``previous`` and ``prior_year`` structs by calendar key (NULL when absent)."""
    w = Window.partitionBy(ENTITY).orderBy("period_index")
    s = _metrics_struct(COMPARISON_METRICS)
    return eligible.select(
        "*",
        F.first(s).over(w.rangeBetween(-1, -1)).alias("previous"),
        F.first(s).over(w.rangeBetween(-4, -4)).alias("prior_year"),
    )


def neighbor_keys(period_index: Column, offset: int) -> Column:
    """Identifier of the quarter ``offset`` quarters before ``period_index``."""
    k = period_index - offset - 1
    fy = F.floor(k / 4).cast("int")
    q = (k - fy * 4 + 1).cast("int")
    return period_identifier(fy, F.concat(F.lit("Q"), q.cast("string")))


def with_asof_annual(periods: DataFrame, annual: DataFrame) -> DataFrame:
    """``annual`` struct = latest complete year available as of each period."""
    ann = annual.where(_all_core_present()).select(
        ENTITY, (F.col("fiscal_year") * 4 + 4).alias("_key"), F.lit(0).alias("_kind"),
        _metrics_struct(ANNUAL_METRICS, with_period=False).alias("_ann"))
    per = periods.select("*", F.col("period_index").alias("_key"), F.lit(1).alias("_kind"))
    u = per.unionByName(ann, allowMissingColumns=True)
    w = Window.partitionBy(ENTITY).orderBy("_key", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = u.withColumn("annual", F.last("_ann", ignorenulls=True).over(w)).where(F.col("_kind") == 1)
    return out.drop("_key", "_kind", "_ann")


def grounding_contexts(analytics: DataFrame, annual: DataFrame) -> DataFrame:
    """I9 (wide form): one row per eligible period with previous / prior_year / annual structs."""
    return with_asof_annual(with_neighbors(eligible_periods(analytics)), annual)


def _roles() -> str:
    """SQL of a period's four roles: ``(role, period_id, source_id, listed (metric, unit, value))``, texts made once a role."""
    def role(name: str, dataset: str, period_id: str, prefix: str, metrics: list[str]) -> str:
        listed = ", ".join(f"named_struct('metric', '{m}', 'unit', '{'percent' if m in PERCENT_METRICS else 'usd'}', "
                           f"'value', cast({prefix}{m} as decimal(38,6)))" for m in metrics)
        return (f"named_struct('role', '{name}', 'period_id', {period_id}, 'source_id', concat('{dataset}:', {period_id}), "
                f"'listed', array({listed}))")

    def quarter(prefix: str) -> str:
        return f"concat('FY', cast({prefix}fiscal_year as string), '-', {prefix}fiscal_period)"

    roles = [role("current", QUARTER_DATASET, quarter(""), "", PERIOD_METRICS)]
    roles += [role(r, QUARTER_DATASET, quarter(f"{r}."), f"{r}.", COMPARISON_METRICS) for r in ("previous", "prior_year")]
    roles.append(role("annual", ANNUAL_DATASET, "concat('FY', cast(annual.fiscal_year as string))", "annual.", ANNUAL_METRICS))
    return f"array({', '.join(roles)})"


def figure_array() -> Column:
    """I9 over grounding contexts: the period's figures in the order current, previous,
    prior year, annual; NULL figures and absent roles are omitted.

    Written as one SQL text: it has a struct per role and metric.
    """
    return F.expr(f"flatten(transform({_roles()}, r -> transform(filter(r.listed, m -> m.value IS NOT NULL), m -> "
                  "named_struct('role', r.role, 'period_id', r.period_id, 'source_id', r.source_id, 'metric', m.metric, "
                  "'unit', m.unit, 'value', m.value))))")


def with_figures(contexts: DataFrame) -> DataFrame:
    """I9 (nested form): one row per period with its ``figures``."""
    return contexts.select(*PERIOD, figure_array().alias("figures"))


def grounded_figures(contexts: DataFrame) -> DataFrame:
    """I9 (long form): (entity, requested period, role, source, metric, unit, value)."""
    roles = contexts.select(*PERIOD, F.explode(F.expr(_roles())).alias("r"))
    x = roles.select(*PERIOD, "r.role", "r.period_id", "r.source_id", F.explode("r.listed").alias("f"))
    return x.select(*PERIOD, "role", "period_id", "source_id", "f.metric", "f.unit", "f.value").where(F.col("value").isNotNull())


def figure_rules(figures: DataFrame) -> DataFrame:
    """Per (entity, period, role) the grounded-figure invariants, as violation counts.

    metric <-> unit, integral USD, unique metric per role, one source per
    role, and the source ID equals ``dataset:period``.
    """
    expected_unit = F.when(F.col("metric").isin(*PERCENT_METRICS), "percent").otherwise("usd")
    dataset = F.when(F.col("role") == "annual", ANNUAL_DATASET).otherwise(QUARTER_DATASET)
    g = figures.groupBy(*PERIOD, "role").agg(
        F.count(F.lit(1)).alias("figures"),
        F.count_distinct("metric").alias("distinct_metrics"),
        F.count_distinct("source_id").alias("sources"),
        F.sum(F.when(F.col("unit") != expected_unit, 1).otherwise(0)).alias("bad_units"),
        F.sum(F.when((F.col("unit") == "usd") & (F.col("value") != F.floor("value")), 1).otherwise(0))
        .alias("non_integral"),
        F.sum(F.when(F.col("source_id") != F.concat(dataset, F.lit(":"), F.col("period_id")), 1).otherwise(0))
        .alias("bad_source_ids"),
    )
    violations = (F.col("bad_units") + F.col("non_integral") + F.col("bad_source_ids")
                  + (F.col("figures") - F.col("distinct_metrics")) + (F.col("sources") - 1))
    return g.select(*PERIOD, "role", F.col("figures").cast("bigint").alias("figures"),
                    F.col("distinct_metrics").cast("bigint").alias("distinct_metrics"),
                    F.col("sources").cast("bigint").alias("sources"),
                    F.col("bad_units").cast("bigint").alias("bad_units"),
                    F.col("non_integral").cast("bigint").alias("non_integral"),
                    F.col("bad_source_ids").cast("bigint").alias("bad_source_ids"),
                    violations.cast("bigint").alias("violations"))


def plain_decimal(value: Column) -> Column:
    """Decimal as plain text without trailing zeros: ``90007000000``, ``17.75``."""
    text = F.regexp_replace(value.cast("decimal(38,6)").cast("string"), "0+$", "")
    return F.regexp_replace(text, r"\.$", "")


def context_json(drivers: Column | None = None) -> Column:
    """H9 over grounding contexts: the approved context of a period as deterministic JSON.

    Keys stand in alphabetical order at every level, figures in the order of
    their metrics, sources in the order current, previous, prior year, annual;
    figures without a value are left out, absent roles are null.
    ``drivers``: the business-driver part, if the context has one.
    """
    def source(dataset: str, period_id: Column) -> Column:
        return F.concat(F.lit(dataset + ":"), period_id)

    def figures(metrics: list[str], value, source_id: Column) -> Column:
        all_ = F.array(*[F.struct(
            F.lit(m).alias("metric"), source_id.alias("source_id"),
            F.lit("percent" if m in PERCENT_METRICS else "usd").alias("unit"), plain_decimal(value(m)).alias("value"))
            for m in metrics])
        return F.filter(all_, lambda f: f["value"].isNotNull())

    def period(fy: Column, fp: Column) -> Column:
        return F.struct(fp.alias("fiscal_period"), fy.cast("int").alias("fiscal_year"))

    def quarter(metrics: list[str], value, fy: Column, fp: Column) -> Column:
        sid = source(QUARTER_DATASET, period_identifier(fy, fp))
        return F.struct(figures(metrics, value, sid).alias("figures"), period(fy, fp).alias("period"), sid.alias("source_id"))

    def role(name: str) -> Column:
        r = F.col(name)
        return F.when(r.isNotNull(), quarter(COMPARISON_METRICS, lambda m: r[m], r["fiscal_year"], r["fiscal_period"]))

    def reference(dataset: str, period_id: Column) -> Column:
        return F.struct(F.lit(dataset).alias("dataset"), period_id.alias("period_id"), source(dataset, period_id).alias("source_id"))

    fy, fp, a = F.col("fiscal_year"), F.col("fiscal_period"), F.col("annual")
    annual_id = F.concat(F.lit("FY"), a["fiscal_year"].cast("string"))
    annual_source = source(ANNUAL_DATASET, annual_id)
    sources = F.filter(F.array(
        reference(QUARTER_DATASET, period_identifier(fy, fp)),
        *[F.when(F.col(r).isNotNull(), reference(QUARTER_DATASET, period_identifier(F.col(r)["fiscal_year"], F.col(r)["fiscal_period"])))
          for r in ("previous", "prior_year")],
        F.when(a.isNotNull(), reference(ANNUAL_DATASET, annual_id))), lambda s: s.isNotNull())
    doc = F.struct(
        F.when(a.isNotNull(), F.struct(
            figures(ANNUAL_METRICS, lambda m: a[m], annual_source).alias("figures"), a["fiscal_year"].cast("int").alias("fiscal_year"),
            annual_source.alias("source_id"))).alias("annual_context"),
        *([] if drivers is None else [drivers.alias("business_drivers")]),
        quarter(PERIOD_METRICS, F.col, fy, fp).alias("current_period"),
        F.concat(F.lit("Entity "), F.col(ENTITY).cast("string")).alias("entity"),
        role("previous").alias("previous_quarter"), role("prior_year").alias("prior_year_quarter"),
        period(fy, fp).alias("requested_period"), F.lit("1.0").alias("schema_version"), sources.alias("sources"))
    return F.to_json(doc, {"ignoreNullFields": "false"})


def prompt_context_json(contexts: DataFrame) -> DataFrame:
    """H9: the approved context of every period."""
    return contexts.select(*PERIOD, context_json().alias("context_json"))
