"""As-of grounding: calendar neighbours with gaps and no look-ahead for annual facts."""

from pyspark.sql import functions as F

from quarterline.operators import analytics as A
from quarterline.operators import grounding as G


def _analytics(spark, periods):
    rows = []
    for fy, fp in periods:
        for m in ("revenue", "gross_profit", "operating_income", "net_income"):
            rows.append((3, m, fy, fp, 1000 * fy + int(fp[1])))
    long = spark.createDataFrame(rows, "entity_id bigint, metric string, fiscal_year int, fiscal_period string, "
                                       "value bigint")
    wide = A.quarterly_wide(long)
    return A.quarterly_analytics(wide), A.annual_financials(A.annual_totals(wide)), wide


def test_neighbours_use_calendar_keys_and_annual_has_no_lookahead(spark):
    # FY2025 Q2/Q3 missing on purpose, as in the reference's injected frames
    periods = [(2024, q) for q in ("Q1", "Q2", "Q3", "Q4")] + [(2025, "Q1"), (2025, "Q4")] + \
              [(2026, q) for q in ("Q1", "Q2", "Q3", "Q4")]
    qa, annual, wide = _analytics(spark, periods)
    complete = A.complete_annual(annual, A.complete_years(wide), 2000)
    ctx = {(r.fiscal_year, r.fiscal_period): r for r in G.grounding_contexts(qa, complete).collect()}
    assert ctx[(2025, "Q4")].previous is None
    assert ctx[(2026, "Q1")].previous.fiscal_period == "Q4"
    assert ctx[(2025, "Q4")].prior_year.fiscal_year == 2024
    assert ctx[(2026, "Q2")].prior_year is None
    assert ctx[(2026, "Q3")].annual.fiscal_year == 2024  # FY2025 incomplete, FY2026 not yet complete
    assert ctx[(2026, "Q4")].annual.fiscal_year == 2026  # Q4 sees its own completed year
    assert ctx[(2024, "Q3")].annual is None


def test_figures_and_rules(spark):
    qa, annual, wide = _analytics(spark, [(2024, q) for q in ("Q1", "Q2", "Q3", "Q4")])
    figs = G.grounded_figures(G.grounding_contexts(qa, A.complete_annual(annual, A.complete_years(wide), 2000)))
    q4 = figs.where("fiscal_year = 2024 AND fiscal_period = 'Q4'")
    roles = {r.role for r in q4.select("role").distinct().collect()}
    assert roles == {"current", "previous", "annual"}
    assert q4.where("role = 'annual'").select("source_id").distinct().collect()[0][0] == "annual_financials:FY2024"
    assert G.figure_rules(figs).where("violations <> 0").count() == 0


def test_prompt_context_json_is_deterministic(spark):
    import json

    periods = [(2024, q) for q in ("Q1", "Q2", "Q3", "Q4")] + [(2025, "Q1")]
    qa, annual, wide = _analytics(spark, periods)
    ctx = G.grounding_contexts(qa, A.complete_annual(annual, A.complete_years(wide), 2000))
    docs = {(r.fiscal_year, r.fiscal_period): r.context_json for r in G.prompt_context_json(ctx).collect()}
    d = json.loads(docs[(2024, "Q1")])
    assert list(d) == sorted(d)
    assert d["previous_quarter"] is None and d["annual_context"] is None  # nulls kept, not dropped
    assert list(d["current_period"]) == sorted(d["current_period"])
    figures = {f["metric"]: f for f in d["current_period"]["figures"]}
    assert figures["revenue"] == {"metric": "revenue", "source_id": "quarterly_analytics:FY2024-Q1", "unit": "usd", "value": "2024001"}
    assert d["requested_period"] == {"fiscal_period": "Q1", "fiscal_year": 2024} == d["current_period"]["period"]
    later = json.loads(docs[(2025, "Q1")])
    assert later["annual_context"]["source_id"] == "annual_financials:FY2024" and later["annual_context"]["fiscal_year"] == 2024
    assert later["previous_quarter"]["source_id"] == "quarterly_analytics:FY2024-Q4"
    assert [s["source_id"] for s in later["sources"]] == [
        "quarterly_analytics:FY2025-Q1", "quarterly_analytics:FY2024-Q4", "quarterly_analytics:FY2024-Q1", "annual_financials:FY2024"]


def test_figures_above_2_to_the_53_stay_exact(spark):
    from quarterline.operators import claims as C

    big = 9007199254740993
    wide = spark.createDataFrame([(1, 2024, "Q1", 1, big, 5, 4, 3)], "entity_id bigint, fiscal_year int, fiscal_period string, q int, "
                                 "revenue bigint, gross_profit bigint, operating_income bigint, net_income bigint")
    qa = wide.select("*", *[F.lit(None).cast("double").alias(m) for m in G.PERCENT_METRICS])
    annual = qa.withColumn("fiscal_year", F.lit(2020)).drop("fiscal_period", "q")
    figures = G.grounded_figures(G.grounding_contexts(qa, annual.limit(0)))
    claims = spark.createDataFrame([(1, 2024, "Q1", 0, i, "quarterly_analytics:FY2024-Q1", "revenue", "usd", str(v))
                                    for i, v in enumerate((big,))], "entity_id bigint, fiscal_year int, fiscal_period string, "
                                   "insight_pos int, claim_pos int, source_id string, metric string, unit string, value string")
    for off, status in ((0, "match"), (-1, "mismatch"), (1, "mismatch")):
        c = claims.withColumn("value", F.col("value").cast("decimal(38,6)") + off)
        assert C.figure_claim_status(c, figures).first()["status"] == status
