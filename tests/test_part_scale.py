"""The queries with one entity per part: one shuffle by entity, dates parsed once, claims checked where they stand."""

from decimal import Decimal

from pyspark.sql import functions as F

from quarterline.functions.arrays import where_late
from quarterline.operators import claims as C
from quarterline.operators import drivers as D
from quarterline.operators import grounding as G
from quarterline.operators import observations as O
from quarterline.plans import q_claims, q_grounding
from quarterline.plans.catalog import Fixtures
from quarterline.sources import testdata

from conftest import SMALL

FIGURE = "struct<role string, period_id string, source_id string, metric string, unit string, value decimal(38,6)>"
CLAIM = "struct<insight_pos int, claim_pos int, metric string, value decimal(38,6), unit string, source_id string>"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(df) -> int:
    return sum("Exchange hashpartitioning" in line and "Reused" not in line for line in _plan(df).splitlines())


def test_f2_derive_q4_part_shuffles_lines_and_entities_only(spark):
    facts = O.facts_from_observations(Fixtures(spark, SMALL, grain="part").obs)
    assert _exchanges(facts) == 2


def test_f2_observation_dates_are_parsed_once(spark):
    obs = Fixtures(spark, SMALL, grain="part").obs
    # start, end and filed; a pushed filter repeated the first two
    assert _plan(O.classify(obs)).count("RLIKE") == 3


def test_f4_contexts_keep_the_entity_partitioning(spark):
    contexts = q_grounding.contexts(Fixtures(spark, SMALL, grain="part"))
    figures = G.grounded_figures(contexts)
    assert "Expand" not in _plan(figures)
    nested = G.with_figures(contexts).select(*G.PERIOD, F.explode("figures").alias("f")).select(*G.PERIOD, "f.*")
    assert figures.count() > 0 and not figures.exceptAll(nested).count() and not nested.exceptAll(figures).count()


def test_f5_segments_are_shuffled_by_entity_once(spark):
    packets = Fixtures(spark, SMALL, grain="part").packets
    hashed = [line for line in _plan(D.contributions(packets)).splitlines() if "Exchange hashpartitioning(entity_id" in line]
    assert len(hashed) == 1


def test_measures_are_exact_in_ten_thousandths(spark):
    lines = spark.createDataFrame([(1, 2, 90449.99, 0.07, 0.08, "R", "1996-07-01"), (1, 2, 0.01, 0.0, 0.0, "N", "1996-06-30"),
                                   (1, 2, None, 0.1, 0.1, "N", "1996-06-30")],
                                  "l_partkey long, l_suppkey long, l_extendedprice double, l_discount double, l_tax double, "
                                  "l_returnflag string, l_shipdate string").withColumn("l_shipdate", F.to_timestamp("l_shipdate"))
    rows = [tuple(r) for r in testdata._line_measures(lines).collect()]
    p = Decimal("90449.99")
    whole = [int(x * 10000) for x in (p, p * Decimal("0.93"), p * Decimal("0.85"), -p)]
    assert rows[0] == (1, 2, 1997, 1, *whole)
    assert rows[1] == (1, 2, 1996, 4, 100, 100, 100, 100)
    assert rows[2][4:] == (None,) * 4


def test_late_filter_keeps_rows_and_column_order(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "c")], "k int, t string")
    assert where_late(df, F.col("t") != "a", beside="k").columns == ["k", "t"]
    assert [tuple(r) for r in where_late(df, F.col("t") != "a", beside="k").collect()] == [(None, "c")]


def test_f1_claim_status_shuffles_no_figures_and_keeps_nothing(spark):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    status = q_claims.Bundle(spark, SMALL, grain="part").fig_status()
    plan = _plan(status)
    assert "InMemoryTableScan" not in plan and "source_id" not in "".join(x for x in plan.splitlines() if "Exchange" in x)
    assert "Join" not in plan and status.count() > 0
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_f1_nested_claim_status_equals_the_long_one(spark):
    v = Decimal("1.500000")
    figures = [("current", "FY1", "s:FY1", "revenue", "usd", Decimal(5)), ("current", "FY1", "s:FY1", "margin", "percent", v),
               ("annual", None, None, "revenue", "usd", Decimal(7))]
    claims = [(0, 0, "revenue", Decimal(5), "usd", "s:FY1"), (0, 1, "margin", v + Decimal("0.01"), "percent", "s:FY1"),
              (0, 2, "margin", v, "percent", "s:FY1"), (1, 0, "revenue", Decimal(7), "usd", None), (1, 1, "revenue", Decimal(7), "usd", None),
              (2, 0, "=revenue", Decimal(5), "usd", "s:FY1"), (2, 1, "cost", Decimal(5), "usd", "s:FY1"),
              (3, 0, None, Decimal(5), "usd", "s:FY1"), (3, 1, "", Decimal(5), "usd", "s:FY1")]
    docs = spark.createDataFrame([(1, 2000, "Q1", figures, claims), (None, 2000, "Q1", figures, claims), (2, 2000, "Q2", figures, []),
                                  (3, 2000, "Q2", [], claims)],
                                 f"entity_id long, fiscal_year int, fiscal_period string, figures array<{FIGURE}>, claims array<{CLAIM}>")
    long = lambda name: docs.select(*C.DOC, F.explode(name).alias("x")).select(*C.DOC, "x.*")
    nested, flat = C.figure_claim_status(docs), C.figure_claim_status(long("claims"), long("figures"))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, nested.collect())) == sorted(map(key, flat.collect()))
    assert nested.columns == flat.columns
