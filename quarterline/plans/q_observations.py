"""Observation pipeline queries: scan, classify, latest-filed, Q4 derivation."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from quarterline.functions.metrics import CONCEPT_OF_METRIC, CORE_METRICS
from quarterline.functions.periods import duration_class, fiscal_period_of, fiscal_year_of, iso_date
from quarterline.operators import observations as O
from quarterline.plans.catalog import Fixtures, register
from quarterline.plans.fixture_sql import with_all
from quarterline.sources import facts_json

_METRIC_CASE = "CASE concept " + " ".join(f"WHEN '{CONCEPT_OF_METRIC[m]}' THEN '{m}'" for m in CORE_METRICS) + " END"
_FY = ("CASE WHEN month(e) IN (9, 12) THEN CAST(year(e) + 1 AS INTEGER) "
       "WHEN month(e) IN (3, 6) THEN CAST(year(e) AS INTEGER) END")
_FP = "CASE month(e) WHEN 9 THEN 'Q1' WHEN 12 THEN 'Q2' WHEN 3 THEN 'Q3' END"

# Typed observations, then the slot; mirrors operators.observations in SQL.
_TYPED = f"""SELECT entity_id, {_METRIC_CASE} AS metric, concept AS sec_metric, seq AS pos,
  CAST(start_date AS DATE) AS s, CAST(end_date AS DATE) AS e, val, accn, fy, fp, form, filed
FROM fx_obs WHERE unit = 'USD'"""
_CLASSIFIED = f"""SELECT *, CASE
    WHEN form = '10-Q' AND coalesce(date_diff('day', s, e) + 1 BETWEEN 80 AND 100, false)
      THEN CASE WHEN derived_period IS NOT NULL AND TRY_CAST(fy AS INTEGER) = fiscal_year
                     AND fp = derived_period THEN 'Q' END
    WHEN form = '10-Q' AND coalesce(date_diff('day', s, e) + 1 BETWEEN 260 AND 285, false)
      THEN CASE WHEN TRY_CAST(fy AS INTEGER) = fiscal_year AND fp = 'Q3' THEN '9M' END
    WHEN form = '10-K' AND coalesce(date_diff('day', s, e) + 1 BETWEEN 350 AND 380, false)
      THEN CASE WHEN TRY_CAST(fy AS INTEGER) = fiscal_year AND fp = 'FY' THEN 'FY' END
  END AS slot
FROM (SELECT *, {_FY} AS fiscal_year, {_FP} AS derived_period FROM typed) t
WHERE metric IS NOT NULL AND s IS NOT NULL AND e IS NOT NULL AND val IS NOT NULL AND fiscal_year IS NOT NULL"""
_Q = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity_id, metric, fiscal_year, derived_period
    ORDER BY coalesce(CAST(filed AS DATE), DATE '0001-01-01') DESC, pos ASC) AS rn FROM cl WHERE slot = 'Q') WHERE rn = 1"""
_N = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity_id, metric, fiscal_year
    ORDER BY coalesce(filed, '') DESC, pos ASC) AS rn FROM cl WHERE slot = '9M') WHERE rn = 1"""
_A = _N.replace("'9M'", "'FY'")
_J = """SELECT a.entity_id, a.metric, a.sec_metric, a.fiscal_year, a.e AS a_end, a.val AS a_val, a.filed AS a_filed,
  a.accn AS a_accn, n.e AS n_end, n.val AS n_val, n.accn AS n_accn,
  CASE WHEN n.entity_id IS NULL THEN 'missing_nine_month'
       WHEN n.e >= a.e THEN 'inconsistent_dates'
       WHEN a.val - n.val < 0 AND a.metric IN ('revenue', 'gross_profit') THEN 'negative_value' END AS reason
FROM an a LEFT JOIN nm n ON a.entity_id = n.entity_id AND a.metric = n.metric AND a.fiscal_year = n.fiscal_year"""
_FACTS = """SELECT entity_id, metric, sec_metric, s AS start_date, e AS end_date, fiscal_year,
  derived_period AS fiscal_period, CAST(val AS BIGINT) AS value, form, CAST(filed AS DATE) AS filed_date,
  accn AS accession_number FROM qq
UNION ALL
SELECT entity_id, metric, sec_metric, CAST(n_end + INTERVAL 1 DAY AS DATE), a_end, fiscal_year, 'Q4',
  CAST(a_val - n_val AS BIGINT), 'DERIVED', CAST(a_filed AS DATE), a_accn || ' | ' || n_accn
FROM j WHERE reason IS NULL"""

_PIPE = [("typed", _TYPED), ("cl", _CLASSIFIED), ("qq", _Q), ("nm", _N), ("an", _A), ("j", _J), ("facts", _FACTS)]


def _sql(select: str, upto: str = "facts") -> str:
    names = [n for n, _ in _PIPE]
    return with_all("fx_obs", extra=_PIPE[: names.index(upto) + 1]) + "\n" + select


def _facts(fx: Fixtures):
    return O.facts_from_observations(fx.obs)


@register("derive_q4", sql=_sql("SELECT * FROM facts"))
def q_derive_q4(spark, sf_dir):
    """C1 + G1 (+ B6-B8, D4, D5): observations -> long facts with derived Q4."""
    return _facts(Fixtures(spark, sf_dir))


@register("q4_underivable", sql=_sql("SELECT entity_id, metric, fiscal_year, reason FROM j WHERE reason IS NOT NULL",
                                     upto="j"))
def q_q4_underivable(spark, sf_dir):
    return O.underivable_q4(O.select_latest(O.classify(Fixtures(spark, sf_dir).obs)))


@register("latest_filed", sql=_sql(
    "SELECT entity_id, metric, fiscal_year, derived_period AS fiscal_period, CAST(val AS BIGINT) AS value, "
    "filed, accn FROM qq UNION ALL SELECT entity_id, metric, fiscal_year, slot AS fiscal_period, "
    "CAST(val AS BIGINT), filed, accn FROM nm UNION ALL SELECT entity_id, metric, fiscal_year, slot, "
    "CAST(val AS BIGINT), filed, accn FROM an", upto="an"))
def q_latest_filed(spark, sf_dir):
    """The winning observation per slot (Q1..Q3 by filed date, 9M / FY by filed text)."""
    latest = O.select_latest(O.classify(Fixtures(spark, sf_dir).obs))
    slots = F.array(*[F.struct(F.lit(n).alias("p"), F.col(c).alias("o"))
                      for n, c in (("Q1", "q1"), ("Q2", "q2"), ("Q3", "q3"), ("9M", "nine"), ("FY", "annual"))])
    x = latest.select("entity_id", "metric", "fiscal_year", F.explode(slots).alias("r")).where(F.col("r.o").isNotNull())
    return x.select("entity_id", "metric", "fiscal_year", F.col("r.p").alias("fiscal_period"),
                    F.col("r.o.value").alias("value"), F.col("r.o.filed").alias("filed"),
                    F.col("r.o.accn").alias("accn"))


@register("slot_counts", sql=_sql("SELECT entity_id, slot, count(*) AS observations FROM cl WHERE slot IS NOT NULL "
                                  "GROUP BY entity_id, slot", upto="cl"))
def q_slot_counts(spark, sf_dir):
    """How many observations land in each slot, per entity."""
    return O.classify(Fixtures(spark, sf_dir).obs).groupBy("entity_id", "slot").agg(
        F.count(F.lit(1)).alias("observations"))


@register("own_period_filter", sql=_sql(
    "SELECT entity_id, metric, pos AS seq, fy, fp, fiscal_year, derived_period, "
    "coalesce(TRY_CAST(fy AS INTEGER) = fiscal_year AND fp = coalesce(derived_period, "
    "CASE WHEN form = '10-K' THEN 'FY' ELSE 'Q3' END), false) AS own_period "
    "FROM (SELECT *, {fy} AS fiscal_year, {fp} AS derived_period FROM typed) t "
    "WHERE metric IS NOT NULL AND s IS NOT NULL AND e IS NOT NULL AND val IS NOT NULL AND fiscal_year IS NOT NULL"
    .format(fy=_FY, fp=_FP), upto="typed"))
def q_own_period_filter(spark, sf_dir):
    """Rows with the required fields, flagged when fy/fp are the row's own period.

    The period compared is the quarter from the end month, or the slot a
    cumulative row would claim (FY for 10-K, Q3 for a 10-Q without one).
    """
    obs = Fixtures(spark, sf_dir).obs
    e = iso_date(F.col("end_date"))
    x = obs.where(F.col("unit") == "USD").select(
        "entity_id", O.metric_of_concept(F.col("concept")).alias("metric"), "seq", "fy", "fp", "form",
        "start_date", "end_date", "val",
        fiscal_year_of(e).alias("fiscal_year"), fiscal_period_of(e).alias("derived_period"),
    ).where(F.col("metric").isNotNull() & (F.coalesce(F.col("start_date"), F.lit("")) != "")
            & (F.coalesce(F.col("end_date"), F.lit("")) != "") & F.col("val").isNotNull()
            & F.col("fiscal_year").isNotNull())
    claimed = F.coalesce(F.col("derived_period"), F.when(F.col("form") == "10-K", "FY").otherwise("Q3"))
    return x.select("entity_id", "metric", "seq", "fy", "fp", "fiscal_year", "derived_period",
                    O.own_period(F.col("fy"), F.col("fp"), F.col("fiscal_year"), claimed).alias("own_period"))


@register("duration_days", sql=with_all("fx_obs") + """
SELECT entity_id, concept, seq, fy, fp,
  CAST(date_diff('day', CAST(start_date AS DATE), CAST(end_date AS DATE)) + 1 AS INTEGER) AS duration_days,
  coalesce(date_diff('day', CAST(start_date AS DATE), CAST(end_date AS DATE)) + 1 BETWEEN 80 AND 100, false)
    AS is_quarter_duration
FROM fx_obs""")
def q_duration_days(spark, sf_dir):
    """B1/B2 over every observation (instants give NULL days and false)."""
    return O.observation_durations(Fixtures(spark, sf_dir).obs)


@register("duration_class_counts", sql=with_all("fx_obs") + """
SELECT concept, duration_class, count(*) AS observations FROM (
  SELECT concept, CASE WHEN start_date IS NULL THEN 'Instant'
    WHEN d BETWEEN 80 AND 100 THEN 'Quarter' WHEN d BETWEEN 170 AND 195 THEN 'Six Months'
    WHEN d BETWEEN 260 AND 285 THEN 'Nine Months' WHEN d BETWEEN 350 AND 380 THEN 'Full Year'
    ELSE 'Other' END AS duration_class
  FROM (SELECT *, date_diff('day', CAST(start_date AS DATE), CAST(end_date AS DATE)) + 1 AS d FROM fx_obs) x
) y GROUP BY concept, duration_class""")
def q_duration_class_counts(spark, sf_dir):
    """Observation counts per concept and duration class."""
    obs = Fixtures(spark, sf_dir).obs
    cls = duration_class(iso_date(F.col("start_date")), iso_date(F.col("end_date")))
    return obs.groupBy("concept", cls.alias("duration_class")).agg(F.count(F.lit(1)).alias("observations"))


@register("fiscal_period_of", sql=with_all("fx_obs") + f"""
SELECT entity_id, concept, seq, end_date, {_FY.replace('(e)', '(CAST(end_date AS DATE))')} AS fiscal_year,
  {_FP.replace('(e)', '(CAST(end_date AS DATE))')} AS fiscal_period
FROM fx_obs""")
def q_fiscal_period_of(spark, sf_dir):
    """Fiscal year and quarter slot from every observation's end date."""
    obs = Fixtures(spark, sf_dir).obs
    e = iso_date(F.col("end_date"))
    return obs.select("entity_id", "concept", "seq", "end_date",
                      fiscal_year_of(e).alias("fiscal_year"), fiscal_period_of(e).alias("fiscal_period"))


@register("facts_sorted", sql=_sql(
    "SELECT *, CAST(row_number() OVER (PARTITION BY entity_id ORDER BY fiscal_year, "
    "CASE fiscal_period WHEN 'Q1' THEN 1 WHEN 'Q2' THEN 2 WHEN 'Q3' THEN 3 WHEN 'Q4' THEN 4 END, metric) "
    "AS INTEGER) AS position FROM facts"))
def q_facts_sorted(spark, sf_dir):
    """facts with their per-entity chronological position."""
    return O.sort_facts(_facts(Fixtures(spark, sf_dir)))


@register("facts_json_explode", sql=with_all("fx_obs") + """
SELECT entity_id, concept, unit, CAST(row_number() OVER (PARTITION BY entity_id, fy, concept
         ORDER BY end_date, seq) - 1 AS INTEGER) AS pos,
  start_date, end_date, CAST(val AS BIGINT) AS val, accn, CAST(fy AS VARCHAR) AS fy, fp, form, filed
FROM fx_obs""")
def q_facts_json_explode(spark, sf_dir):
    """A1: observations written as nested JSON documents by Spark, then parsed back
    with an explicit schema and exploded map -> map -> array."""
    docs = facts_json.documents_from_observations(Fixtures(spark, sf_dir).obs)
    rows = facts_json.explode_documents(docs)
    return rows.select("entity_id", "concept", "unit", "pos", "start_date", "end_date",
                       F.col("val").cast("bigint").alias("val"), "accn", "fy", "fp", "form", "filed")


@register("facts_from_json", sql=_sql("SELECT * FROM facts"))
def q_facts_from_json(spark, sf_dir):
    """A1 -> C1 end to end: facts derived from the parsed documents (position = array index)."""
    docs = facts_json.documents_from_observations(Fixtures(spark, sf_dir).obs)
    rows = facts_json.explode_documents(docs)
    return O.facts_from_observations(rows, position="pos")


@register("concept_last_n", sql=with_all("fx_obs") + """
SELECT entity_id, concept, unit, end_date, seq, CAST(val AS BIGINT) AS val, form, CAST(rn AS INTEGER) AS recency
FROM (SELECT *, row_number() OVER (PARTITION BY entity_id, concept, unit ORDER BY end_date DESC, seq DESC) AS rn
      FROM fx_obs) x WHERE rn <= 10""")
def q_concept_last_n(spark, sf_dir):
    """The last 10 observations per entity, concept and unit (a top-k report)."""
    obs = Fixtures(spark, sf_dir).obs
    w = Window.partitionBy("entity_id", "concept", "unit").orderBy(F.col("end_date").desc(), F.col("seq").desc())
    return (obs.withColumn("recency", F.row_number().over(w)).where(F.col("recency") <= 10)
            .select("entity_id", "concept", "unit", "end_date", "seq", "val", "form", "recency"))


@register("concept_profile", sql=with_all("fx_obs") + """
SELECT concept, unit, count(*) AS observations, count(DISTINCT entity_id) AS entities,
  min(end_date) AS first_end, max(end_date) AS last_end, count(DISTINCT form) AS forms
FROM fx_obs GROUP BY concept, unit""")
def q_concept_profile(spark, sf_dir):
    """Observation counts per concept and unit."""
    obs = Fixtures(spark, sf_dir).obs
    return obs.groupBy("concept", "unit").agg(
        F.count(F.lit(1)).alias("observations"), F.countDistinct("entity_id").alias("entities"),
        F.min("end_date").alias("first_end"), F.max("end_date").alias("last_end"),
        F.countDistinct("form").alias("forms"))


@register("concept_search", sql="""
SELECT p_partkey, p_name, p_type FROM part
WHERE strpos(lower(concat_ws(' ', p_name, p_type, p_brand)), 'gear') > 0""")
def q_concept_search(spark, sf_dir):
    """H1: case-insensitive substring search over name, label and description text."""
    part = Fixtures(spark, sf_dir).table("part")
    hay = F.lower(F.concat_ws(" ", "p_name", "p_type", "p_brand"))
    return part.where(hay.contains(F.lower(F.lit("Gear")))).select("p_partkey", "p_name", "p_type")


@register("quarter_ordinal", sql=with_all("fx_obs") + """
SELECT entity_id, concept, seq, fp, CAST(CASE fp WHEN 'Q1' THEN 1 WHEN 'Q2' THEN 2 WHEN 'Q3' THEN 3 WHEN 'Q4' THEN 4
  END AS INTEGER) AS quarter_number FROM fx_obs""")
def q_quarter_ordinal(spark, sf_dir):
    """Period label -> ordinal; anything else (here 'FY') is NULL and left to the quality report."""
    from quarterline.functions.periods import quarter_number

    obs = Fixtures(spark, sf_dir).obs
    return obs.select("entity_id", "concept", "seq", "fp", quarter_number("fp").alias("quarter_number"))


_PID_TEXT = "CASE WHEN seq = 2 THEN lower('FY' || CAST(fy AS VARCHAR) || '-' || fp) WHEN seq = 8 THEN ' FY' || " \
            "CAST(fy AS VARCHAR) || '-' || fp ELSE 'FY' || CAST(fy AS VARCHAR) || '-' || fp END"


@register("period_parse", sql=with_all("fx_obs") + f"""
SELECT entity_id, concept, seq, t AS period_text,
  CASE WHEN ok THEN y END AS fiscal_year, CASE WHEN ok THEN regexp_extract(t, '^FY(\\d{{4}})-(Q[1-4])$', 2) END
    AS fiscal_period
FROM (SELECT *, regexp_full_match(t, '^FY(\\d{{4}})-(Q[1-4])$')
          AND coalesce(y BETWEEN 1900 AND 9999, false) AS ok
      FROM (SELECT *, TRY_CAST(regexp_extract(t, '^FY(\\d{{4}})-(Q[1-4])$', 1) AS INTEGER) AS y
            FROM (SELECT *, {_PID_TEXT} AS t FROM fx_obs) a) b) c""")
def q_period_parse(spark, sf_dir):
    """Strict, case-sensitive, whole-string identifier parse of texts built from the
    filings (comparative rows lower-cased, instants with a leading blank, 'FY' periods)."""
    from quarterline.functions.periods import parse_period

    obs = Fixtures(spark, sf_dir).obs
    base = F.concat(F.lit("FY"), F.col("fy").cast("string"), F.lit("-"), F.col("fp"))
    text = F.when(F.col("seq") == 2, F.lower(base)).when(F.col("seq") == 8, F.concat(F.lit(" "), base)).otherwise(base)
    x = obs.select("entity_id", "concept", "seq", text.alias("period_text"))
    p = parse_period(F.col("period_text"))
    return x.select("*", p["fiscal_year"].alias("fiscal_year"), p["fiscal_period"].alias("fiscal_period"))
