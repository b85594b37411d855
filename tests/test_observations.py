"""Observation selection: own-period rule, latest filed, ties, Q4 derivation and reasons."""

from quarterline.operators import observations as O
from quarterline.plans.catalog import Fixtures
from quarterline.sources import facts_json

from conftest import SMALL

COLS = ("entity_id bigint, concept string, unit string, seq int, start_date string, end_date string, val bigint, "
        "accn string, fy string, fp string, form string, filed string")
REV = "RevenueFromContractWithCustomerExcludingAssessedTax"
NI = "NetIncomeLoss"


def _obs(spark, rows):
    return spark.createDataFrame(rows, COLS)


def test_tie_restatement_comparative_and_q4(spark):
    rows = [
        (1, REV, "USD", 1, "2025-07-01", "2025-09-30", 100, "a1", "2026", "Q1", "10-Q", "2025-10-25"),
        (1, REV, "USD", 2, "2025-07-01", "2025-09-30", 999, "a2", "2026", "Q1", "10-Q", "2025-10-25"),  # tie: loses
        (1, REV, "USD", 3, "2025-07-01", "2025-09-30", 555, "a3", "2027", "Q1", "10-Q", "2026-10-25"),  # comparative
        (1, REV, "USD", 4, "2025-10-01", "2025-12-31", 200, "b1", "2026", "Q2", "10-Q", "2026-01-25"),
        (1, REV, "USD", 5, "2025-10-01", "2025-12-31", 210, "b2", "2026", "Q2", "10-Q", "2026-03-01"),  # restated
        (1, REV, "USD", 6, "2025-07-01", "2026-03-31", 600, "n1", "2026", "Q3", "10-Q", "2026-04-25"),
        (1, REV, "USD", 7, "2025-07-01", "2026-06-30", 900, "y1", "2026", "FY", "10-K", "2026-07-30"),
        (1, REV, "USD", 8, None, "2026-06-30", 1, "i1", "2026", "FY", "10-K", "2026-07-30"),  # instant
        (1, NI, "USD", 1, "2024-07-01", "2025-06-30", 50, "y2", "2025", "FY", "10-K", "2025-07-30"),  # no 9M
        (1, NI, "USD", 2, "2025-07-01", "2026-06-30", 50, "y3", "2026", "FY", "10-K", "2026-07-30"),
        (1, NI, "USD", 3, "2025-07-01", "2026-03-31", 80, "n3", "2026", "Q3", "10-Q", "2026-04-25"),  # NI may go < 0
    ]
    facts = {(r.metric, r.fiscal_year, r.fiscal_period): r
             for r in O.facts_from_observations(_obs(spark, rows)).collect()}
    assert facts[("revenue", 2026, "Q1")].value == 100
    assert facts[("revenue", 2026, "Q2")].value == 210
    q4 = facts[("revenue", 2026, "Q4")]
    assert q4.value == 300 and q4.form == "DERIVED" and q4.accession_number == "y1 | n1"
    assert str(q4.start_date) == "2026-04-01" and str(q4.end_date) == "2026-06-30"
    assert facts[("net_income", 2026, "Q4")].value == -30
    reasons = {(r.metric, r.fiscal_year): r.reason
               for r in O.underivable_q4(O.select_latest(O.classify(_obs(spark, rows)))).collect()}
    assert reasons == {("net_income", 2025): "missing_nine_month"}


def test_negative_revenue_q4_is_rejected(spark):
    rows = [(2, REV, "USD", 1, "2025-07-01", "2026-03-31", 900, "n", "2026", "Q3", "10-Q", "2026-04-25"),
            (2, REV, "USD", 2, "2025-07-01", "2026-06-30", 800, "y", "2026", "FY", "10-K", "2026-07-30")]
    latest = O.select_latest(O.classify(_obs(spark, rows)))
    assert O.derive_facts(latest).count() == 0
    assert [r.reason for r in O.underivable_q4(latest).collect()] == ["negative_value"]


def test_fixture_invariants(spark):
    fx = Fixtures(spark, SMALL)
    facts = O.facts_from_observations(fx.obs)
    joined = facts.join(fx.long.select("entity_id", "metric", "fiscal_year", "fiscal_period",
                                       fx.long.value.alias("expected")),
                        ["entity_id", "metric", "fiscal_year", "fiscal_period"])
    q4 = joined.where("fiscal_period = 'Q4'")
    assert q4.count() > 0 and q4.where("value <> expected").count() == 0
    bumped = joined.where("fiscal_period <> 'Q4' AND value <> expected")
    assert bumped.where("value - expected <> 7 OR entity_id % 5 <> 0").count() == 0


def test_json_documents_round_trip(spark, tmp_path):
    fx = Fixtures(spark, SMALL)
    docs = facts_json.documents_from_observations(fx.obs)
    path = str(tmp_path / "docs")
    docs.select("json").write.text(path)
    rows = facts_json.explode_documents(facts_json.read_documents(spark, path))
    assert rows.count() == fx.obs.count()
    a = O.facts_from_observations(rows, position="pos")
    b = O.facts_from_observations(fx.obs)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
