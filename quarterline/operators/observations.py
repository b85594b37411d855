"""Filing observations -> quarterly facts, with the fourth quarter derived.

Pipeline (one shuffle from observations to facts):

1. ``classify``: map concept -> metric, drop rows missing start/end/value or
   a derivable fiscal year, compute the inclusive duration and put every row
   in exactly one slot: a single quarter (Q1-Q3), the nine-month cumulative
   value or the full year -- or drop it.  A row belongs to its slot only if
   the filing's own ``fy``/``fp`` equal the period its dates describe, which
   rejects comparative values repeated in later filings.
2. ``select_latest``: one ``groupBy(entity, metric, fiscal_year)`` keeps, per
   slot, the most recently filed row with ``max_by`` (first seen wins ties:
   the ordering key is ``(filed, -position)``).  Partial aggregation runs
   map side, so a hot entity is combined before the exchange.
3. ``derive_facts``: Q4 = full year - nine months in the same row (no join),
   with the reasons a Q4 cannot be derived kept alongside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterline.functions.arrays import where_late
from quarterline.functions.metrics import CONCEPT_OF_METRIC, CORE_METRICS, NON_NEGATIVE_METRICS
from quarterline.functions.periods import (
    FULL_YEAR_DAYS,
    NINE_MONTH_DAYS,
    QUARTER_DAYS,
    duration_between,
    duration_days,
    fiscal_period_of,
    fiscal_year_of,
    iso_date,
    quarter_number,
)

KEY = ["entity_id", "metric", "fiscal_year"]
FACT_COLUMNS = ["entity_id", "metric", "sec_metric", "start_date", "end_date", "fiscal_year",
                "fiscal_period", "value", "form", "filed_date", "accession_number"]


def metric_of_concept(concept: Column) -> Column:
    """Concept -> metric via a literal map (4 entries; unknown concepts give NULL)."""
    pairs = [x for m in CORE_METRICS for x in (F.lit(CONCEPT_OF_METRIC[m]), F.lit(m))]
    return F.element_at(F.create_map(*pairs), concept)


def own_period(fy: Column, fp: Column, fiscal_year: Column, period: Column | str) -> Column:
    """The filing's fy/fp equal the derived period; an unparsable fy is false."""
    p = F.lit(period) if isinstance(period, str) else period
    year_matches = F.coalesce(fy.cast("string").try_cast("int") == fiscal_year, F.lit(False))
    return year_matches & F.coalesce(fp == p, F.lit(False))


def classify(obs: DataFrame, position: str = "seq") -> DataFrame:
    """Typed observations with ``slot`` in {Q, 9M, FY}; others dropped.

    ``obs`` columns: entity_id, concept, unit, <position>, start_date, end_date,
    val, accn, fy, fp, form, filed (dates as ISO text as in the documents).
    """
    parsed = obs.where(F.col("unit") == "USD").select(
        "entity_id",
        metric_of_concept(F.col("concept")).alias("metric"),
        F.col("concept").alias("sec_metric"),
        F.col(position).alias("pos"),
        "start_date", "end_date",
        iso_date(F.col("start_date")).alias("start_d"),
        iso_date(F.col("end_date")).alias("end_d"),
        iso_date(F.col("filed")).alias("filed_d"),
        # a fraction is no fact of an integer table; the scan report counts such values
        F.when(F.col("val") == F.floor("val"), F.col("val")).cast("bigint").alias("val"),
        "accn", "fy", "fp", "form", "filed",
    )
    # every derived column below reads the parsed columns: each date is parsed once per row
    typed = parsed.select(
        "*",
        fiscal_year_of(F.col("end_d")).alias("fiscal_year"),
        fiscal_period_of(F.col("end_d")).alias("derived_period"),
        duration_days("start_d", "end_d").alias("duration"),
    )
    whole = (
        F.col("metric").isNotNull()
        & (F.coalesce(F.col("start_date"), F.lit("")) != "")
        & (F.coalesce(F.col("end_date"), F.lit("")) != "")
        & F.col("val").isNotNull()
        & F.col("fiscal_year").isNotNull()
    )
    form, fy, fp, year, d = F.col("form"), F.col("fy"), F.col("fp"), F.col("fiscal_year"), F.col("duration")
    dur_q = F.coalesce(d.between(*QUARTER_DAYS), F.lit(False))
    dur_9 = F.coalesce(d.between(*NINE_MONTH_DAYS), F.lit(False))
    dur_y = F.coalesce(d.between(*FULL_YEAR_DAYS), F.lit(False))
    slot = (
        F.when((form == "10-Q") & dur_q,
               F.when(F.col("derived_period").isNotNull() & own_period(fy, fp, year, F.col("derived_period")),
                      F.lit("Q")))
        .when((form == "10-Q") & dur_9, F.when(own_period(fy, fp, year, "Q3"), F.lit("9M")))
        .when((form == "10-K") & dur_y, F.when(own_period(fy, fp, year, "FY"), F.lit("FY")))
    )
    # filtered late: a filter is pushed below as a copy of every date it reads, parsed again
    kept = where_late(typed.withColumn("slot", slot), whole & F.col("slot").isNotNull(), beside="entity_id")
    return kept.drop("start_date", "end_date", "duration")


def _obs_struct() -> Column:
    return F.struct(
        F.col("start_d").alias("start_date"), F.col("end_d").alias("end_date"), F.col("val").alias("value"),
        F.col("form").alias("form"), F.col("filed").alias("filed"), F.col("accn").alias("accn"),
    )


def _pick(condition: Column, by_date: bool) -> Column:
    """max_by over the rows meeting ``condition``; later filed wins, first seen on ties.

    Positions restart in every document, so rows of two documents may still
    tie; the accession number then decides.
    """
    filed = F.coalesce(F.col("filed_d"), F.lit("0001-01-01").cast("date")) if by_date \
        else F.coalesce(F.col("filed"), F.lit(""))
    order = F.struct(filed.alias("f"), (-F.col("pos")).alias("p"), F.coalesce(F.col("accn"), F.lit("")).alias("a"))
    return F.max_by(F.when(condition, _obs_struct()), F.when(condition, order))


def select_latest(classified: DataFrame) -> DataFrame:
    """Per (entity, metric, fiscal_year) the winning Q1..Q3, nine-month and
    full-year observations, in one aggregate."""
    slot, dp = F.col("slot"), F.col("derived_period")
    return classified.groupBy(*KEY).agg(
        F.first("sec_metric").alias("sec_metric"),
        *[_pick((slot == "Q") & (dp == q), by_date=True).alias(q.lower()) for q in ("Q1", "Q2", "Q3")],
        _pick(slot == "9M", by_date=False).alias("nine"),
        _pick(slot == "FY", by_date=False).alias("annual"),
    )


def _q4(latest: DataFrame) -> tuple[Column, Column]:
    a, n = F.col("annual"), F.col("nine")
    value = a["value"] - n["value"]
    reason = (
        F.when(a.isNull(), F.lit(None))
        .when(n.isNull(), F.lit("missing_nine_month"))
        .when(n["end_date"] >= a["end_date"], F.lit("inconsistent_dates"))
        .when((value < 0) & F.col("metric").isin(*NON_NEGATIVE_METRICS), F.lit("negative_value"))
    )
    derived = F.when(
        a.isNotNull() & reason.isNull(),
        F.struct(
            F.date_add(n["end_date"], 1).alias("start_date"),
            a["end_date"].alias("end_date"),
            value.alias("value"),
            F.lit("DERIVED").alias("form"),
            a["filed"].alias("filed"),
            F.concat(F.coalesce(a["accn"], F.lit("None")), F.lit(" | "), F.coalesce(n["accn"], F.lit("None"))).alias("accn"),
        ),
    )
    return derived, reason


def derive_facts(latest: DataFrame) -> DataFrame:
    """C1 + G1: reported Q1..Q3 union derived Q4 as the long fact table."""
    derived, _ = _q4(latest)
    periods = F.array(*[
        F.struct(F.lit(q).alias("fiscal_period"), c.alias("o"))
        for q, c in (("Q1", F.col("q1")), ("Q2", F.col("q2")), ("Q3", F.col("q3")), ("Q4", derived))
    ])
    x = latest.select(*KEY, "sec_metric", F.explode(periods).alias("r")).where(F.col("r.o").isNotNull())
    return x.select(
        "entity_id", "metric", "sec_metric",
        F.col("r.o.start_date").alias("start_date"),
        F.col("r.o.end_date").alias("end_date"),
        "fiscal_year",
        F.col("r.fiscal_period").alias("fiscal_period"),
        F.col("r.o.value").alias("value"),
        F.col("r.o.form").alias("form"),
        iso_date(F.col("r.o.filed")).alias("filed_date"),
        F.col("r.o.accn").alias("accession_number"),
    )


def underivable_q4(latest: DataFrame) -> DataFrame:
    """Full years whose Q4 could not be derived, with the reason."""
    _, reason = _q4(latest)
    return latest.select(*KEY, reason.alias("reason")).where(F.col("reason").isNotNull())


def facts_from_observations(obs: DataFrame, position: str = "seq") -> DataFrame:
    return derive_facts(select_latest(classify(obs, position)))


def sort_facts(facts: DataFrame) -> DataFrame:
    """per entity, rows in (fiscal_year, quarter ordinal, metric) order.

    Sorting is done within entity partitions (a range over entities, then a
    local sort) instead of one global order, and the rank is made explicit.
    """
    from pyspark.sql import Window

    w = Window.partitionBy("entity_id").orderBy("fiscal_year", quarter_number("fiscal_period"), "metric")
    return facts.withColumn("position", F.row_number().over(w))


def observation_durations(obs: DataFrame) -> DataFrame:
    """B1/B2: inclusive duration and the quarter-duration flag per observation."""
    s, e = iso_date(F.col("start_date")), iso_date(F.col("end_date"))
    return obs.select(
        "entity_id", "concept", "seq", "fy", "fp",
        duration_days(s, e).alias("duration_days"),
        duration_between(s, e, *QUARTER_DAYS).alias("is_quarter_duration"),
    )
