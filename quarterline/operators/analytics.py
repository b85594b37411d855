"""Quarterly and annual analytics over the long fact table.

Every window is partitioned by ``entity_id`` (the reference has one entity
and no partition key; without it Spark plans a single-partition exchange).
Percentages are computed in DECIMAL and rounded HALF_UP to 2 places, then
cast to DOUBLE at the boundary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterline.functions.metrics import CORE_METRICS, MARGINS
from quarterline.functions.periods import quarter_number

ENTITY = "entity_id"


def pct(num: Column, den: Column) -> Column:
    """``round(100 * num / nullif(den, 0), 2)`` in exact decimal, as DOUBLE."""
    n = num.cast("decimal(20,0)")
    d = den.cast("decimal(20,0)")
    return F.round(F.lit(100).cast("decimal(3,0)") * n / F.nullif(d, F.lit(0)), 2).cast("double")


def pct_try(num: Column, den: Column) -> Column:
    """D2 variant without NULLIF: division by zero is NULL (``try_divide``)."""
    n = num.cast("decimal(20,0)")
    d = den.cast("decimal(20,0)")
    return F.round(F.try_divide(n * F.lit(100).cast("decimal(3,0)"), d), 2).cast("double")


def quarterly_wide(facts: DataFrame) -> DataFrame:
    """Long -> wide with one conditional MAX per metric (one aggregate, no pivot)."""
    return facts.groupBy(ENTITY, "fiscal_year", "fiscal_period").agg(
        *[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in CORE_METRICS]
    )


def executive_dashboard(facts: DataFrame) -> DataFrame:
    """The pivot and three margins in one aggregate; x/0 gives NULL."""
    wide = quarterly_wide(facts)
    return wide.select(
        ENTITY, "fiscal_year", "fiscal_period", *CORE_METRICS,
        *[pct_try(F.col(num), F.col("revenue")).alias(name) for name, num in MARGINS.items()],
    )


def _quarter_window() -> Window:
    return Window.partitionBy(ENTITY).orderBy("fiscal_year", "quarter_number")


def with_margins(df: DataFrame) -> DataFrame:
    return df.select("*", *[pct(F.col(num), F.col("revenue")).alias(name) for name, num in MARGINS.items()])


def quarterly_analytics(wide: DataFrame) -> DataFrame:
    """Positional LAG(1) / LAG(4) of revenue, growth and margins.

    LAG is by row position within the entity, not by calendar (an absent
    quarter shifts it), exactly like the view it mirrors.
    """
    w = _quarter_window()
    base = wide.select("*", quarter_number("fiscal_period").alias("quarter_number"))
    lagged = base.select(
        "*",
        F.lag("revenue", 1).over(w).alias("previous_quarter_revenue"),
        F.lag("revenue", 4).over(w).alias("prior_year_quarter_revenue"),
    )
    qoq = F.col("revenue") - F.col("previous_quarter_revenue")
    yoy = F.col("revenue") - F.col("prior_year_quarter_revenue")
    return lagged.select(
        ENTITY, "fiscal_year", "fiscal_period", "quarter_number", *CORE_METRICS,
        "previous_quarter_revenue", "prior_year_quarter_revenue",
        qoq.alias("revenue_qoq_change"),
        pct(qoq, F.col("previous_quarter_revenue")).alias("revenue_qoq_growth_pct"),
        yoy.alias("revenue_yoy_change"),
        pct(yoy, F.col("prior_year_quarter_revenue")).alias("revenue_yoy_growth_pct"),
        *[pct(F.col(num), F.col("revenue")).alias(name) for name, num in MARGINS.items()],
    )


def latest_per_entity(df: DataFrame, order: list[Column]) -> DataFrame:
    """Top-1 row per entity (planned as a WindowGroupLimit + Window)."""
    w = Window.partitionBy(ENTITY).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def latest_quarter(analytics: DataFrame) -> DataFrame:
    return latest_per_entity(analytics, [F.col("fiscal_year").desc(), F.col("quarter_number").desc()])


def annual_totals(wide: DataFrame) -> DataFrame:
    """D3: SUM by fiscal year (NULLs skipped; all-NULL stays NULL; partial years summed)."""
    return wide.groupBy(ENTITY, "fiscal_year").agg(
        *[F.sum(m).cast("bigint").alias(m) for m in CORE_METRICS]
    )


def annual_financials(totals: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Annual LAG(1) of revenue, operating and net income -> growth columns."""
    w = Window.partitionBy(ENTITY).orderBy("fiscal_year")
    lagged = totals.select(
        "*",
        F.lag("revenue", 1).over(w).alias("prior_year_revenue"),
        F.lag("operating_income", 1).over(w).alias("_prev_oi"),
        F.lag("net_income", 1).over(w).alias("_prev_ni"),
    )
    change = F.col("revenue") - F.col("prior_year_revenue")
    return lagged.select(
        ENTITY, "fiscal_year", *CORE_METRICS, "prior_year_revenue",
        change.alias("revenue_yoy_change"),
        pct(change, F.col("prior_year_revenue")).alias("revenue_yoy_growth_pct"),
        *[pct(F.col(num), F.col("revenue")).alias(name) for name, num in MARGINS.items()],
        pct(F.col("operating_income") - F.col("_prev_oi"), F.col("_prev_oi")).alias("operating_income_yoy_growth_pct"),
        pct(F.col("net_income") - F.col("_prev_ni"), F.col("_prev_ni")).alias("net_income_yoy_growth_pct"),
        *extra,
    )


def complete_years(wide: DataFrame) -> DataFrame:
    """Years whose period set is exactly Q1..Q4 and every metric is present."""
    all_present = F.lit(True)
    for m in CORE_METRICS:
        all_present = all_present & F.col(m).isNotNull()
    periods = F.array_sort(F.collect_set("fiscal_period"))
    return (
        wide.groupBy(ENTITY, "fiscal_year")
        .agg(periods.alias("_periods"), F.bool_and(all_present).alias("_metrics"))
        .where((F.col("_periods") == F.array(*[F.lit(q) for q in ("Q1", "Q2", "Q3", "Q4")])) & F.col("_metrics"))
        .select(ENTITY, "fiscal_year")
    )


def complete_annual(annual: DataFrame, complete: DataFrame, min_fiscal_year: int) -> DataFrame:
    """C6 + B21: annual rows of complete years at or after the floor (semi-join)."""
    return annual.join(complete, [ENTITY, "fiscal_year"], "left_semi").where(F.col("fiscal_year") >= min_fiscal_year)


def scoped(df: DataFrame, min_fiscal_year: int) -> DataFrame:
    """Year floor applied after the analytics windows (never below them)."""
    return df.where(F.col("fiscal_year") >= min_fiscal_year)


def last_n_years(df: DataFrame, n: int = 3) -> DataFrame:
    """Rows of each entity's last ``n`` distinct fiscal years (dense_rank)."""
    w = Window.partitionBy(ENTITY).orderBy(F.col("fiscal_year").desc())
    return df.withColumn("_r", F.dense_rank().over(w)).where(F.col("_r") <= n).drop("_r")


def annual_complete_scoped(wide: DataFrame, min_fiscal_year: int) -> DataFrame:
    """C6 + D3 + D11 + E3 in one aggregate: annual totals and the complete-year
    test come from the same ``groupBy(entity, fiscal_year)``, so completeness is
    a filter after the annual window instead of a semi-join (no extra exchange)."""
    all_present = F.lit(True)
    for m in CORE_METRICS:
        all_present = all_present & F.col(m).isNotNull()
    quarters = F.array(*[F.lit(q) for q in ("Q1", "Q2", "Q3", "Q4")])
    totals = wide.groupBy(ENTITY, "fiscal_year").agg(
        *[F.sum(m).cast("bigint").alias(m) for m in CORE_METRICS],
        ((F.array_sort(F.collect_set("fiscal_period")) == quarters) & F.bool_and(all_present)).alias("_complete"),
    )
    annual = annual_financials(totals, extra=("_complete",))
    return annual.where(F.col("_complete") & (F.col("fiscal_year") >= min_fiscal_year)).drop("_complete")


# Chart names of the margins.
MARGIN_SERIES = {"gross_margin_pct": "Gross margin", "operating_margin_pct": "Operating margin", "net_margin_pct": "Net margin"}


def margin_series(frame: DataFrame, ids: list[str], label: Column) -> DataFrame:
    """The three margins of a quarterly or annual frame as (series, value) rows with a period label."""
    names = F.create_map(*[x for k, v in MARGIN_SERIES.items() for x in (F.lit(k), F.lit(v))])
    long = frame.unpivot(ids, list(MARGIN_SERIES), "series", "value")
    return long.select(*ids, label.alias("period_label"), F.element_at(names, F.col("series")).alias("series"), "value")
