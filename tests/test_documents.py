"""Untrusted documents: shape rules with paths, acceptance stages, the store and re-validation."""

import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from quarterline.operators import documents as DOC
from quarterline.operators.rules import json_schema
from quarterline.sources import document_store as S

PERIOD = {"fiscal_year": 2026, "fiscal_period": "Q4"}
FIGURE = {"metric": "revenue", "value": "90007000000", "unit": "usd", "source_id": "a"}
CLAIM = {"metric": "m", "value": 17.75, "unit": "percent", "classification": "reported", "source_ids": ["a"]}
INSIGHT = {"category": "attention", "title": "T", "narrative": "N", "source_ids": ["a"], "figure_claims": [FIGURE],
           "business_claims": [CLAIM], "management_explanation_ids": ["demand"]}
BRIEFING = {"reporting_period": PERIOD, "headline": " H ", "executive_summary": "S", "insights": [INSIGHT], "source_ids": ["a"]}
ANSWER = {"reporting_period": PERIOD, "status": "supported", "answer": "A", "claims": [
    {"metric": "revenue", "classification": "reported_fact", "value": "1", "unit": "usd", "source_ids": ["a"]}],
    "metric_names": ["revenue"], "source_ids": ["a"], "suggested_investigation_areas": []}


def put(doc, path, value):
    """A deep copy with the value at a path; ``...`` removes it."""
    out = json.loads(json.dumps(doc))
    at = out
    for key in path[:-1]:
        at = at[key]
    if value is ...:
        del at[path[-1]]
    else:
        at[path[-1]] = value
    return out


I0, F0, B0 = ["insights", 0], ["insights", 0, "figure_claims", 0], ["insights", 0, "business_claims", 0]
BRIEFINGS = [
    (BRIEFING, []),
    (put(BRIEFING, ["schema_version"], "1.0"), []),
    (put(BRIEFING, ["schema_version"], "2.0"), ["schema_version: domain"]),
    (put(BRIEFING, ["note"], 1), ["note: unknown"]),
    (put(BRIEFING, ["headline"], ...), ["headline: missing"]),
    (put(BRIEFING, ["headline"], None), ["headline: type"]),
    (put(BRIEFING, ["headline"], "x" * 140), []),
    (put(BRIEFING, ["headline"], "x" * 141), ["headline: length"]),
    (put(BRIEFING, ["headline"], " \n"), ["headline: length"]),
    (put(BRIEFING, ["headline"], 5), ["headline: type"]),
    (put(BRIEFING, ["executive_summary"], "x" * 801), ["executive_summary: length"]),
    (put(BRIEFING, ["reporting_period", "fiscal_year"], 1899), ["reporting_period.fiscal_year: range"]),
    (put(BRIEFING, ["reporting_period", "fiscal_year"], "2026"), ["reporting_period.fiscal_year: type"]),
    (put(BRIEFING, ["reporting_period", "fiscal_period"], "Q5"), ["reporting_period.fiscal_period: domain"]),
    (put(BRIEFING, ["reporting_period"], "FY2026-Q4"), ["reporting_period: type"]),
    (put(BRIEFING, ["insights"], []), ["insights: too_few"]),
    (put(BRIEFING, ["insights"], [INSIGHT] * 7), ["insights: too_many"]),
    (put(BRIEFING, ["insights"], {}), ["insights: type"]),
    (put(BRIEFING, ["source_ids"], []), ["source_ids: too_few"]),
    (put(BRIEFING, ["source_ids"], ["a", "a"]), ["$: duplicate_sources"]),
    (put(BRIEFING, [*I0, "category"], "outlook"), ["insights[0].category: domain"]),
    (put(BRIEFING, [*I0, "title"], "x" * 81), ["insights[0].title: length"]),
    (put(BRIEFING, [*I0, "narrative"], "x" * 501), ["insights[0].narrative: length"]),
    (put(BRIEFING, [*I0, "classification"], "guess"), ["insights[0].classification: domain"]),
    (put(BRIEFING, [*I0, "source_ids"], ["b"]), ["insights[0]: claim_sources"]),
    (put(BRIEFING, [*I0, "source_ids"], []), []),
    (put(BRIEFING, [*F0, "metric"], "profit"), ["insights[0].figure_claims[0].metric: domain"]),
    (put(BRIEFING, [*F0, "value"], True), ["insights[0].figure_claims[0].value: type"]),
    (put(BRIEFING, [*F0, "value"], "NaN"), ["insights[0].figure_claims[0].value: value"]),
    (put(BRIEFING, [*F0, "unit"], "eur"), ["insights[0].figure_claims[0].unit: domain"]),
    (put(BRIEFING, [*B0, "classification"], "ai_interpretation"), ["insights[0].business_claims[0].classification: domain"]),
    (put(BRIEFING, [*B0, "source_ids"], []), ["insights[0].business_claims[0].source_ids: too_few"]),
    (put(put(BRIEFING, [*F0, "mood"], 1), ["headline"], ...), ["headline: missing", "insights[0].figure_claims[0].mood: unknown"]),
    ([], ["$: type"]),
]
C0 = ["claims", 0]
MANAGED = {"metric": "demand", "classification": "management_explanation", "source_ids": ["a"], "management_explanation_id": "demand"}
ANSWERS = [
    (ANSWER, []),
    (put(put(ANSWER, ["claims"], [MANAGED]), ["metric_names"], ["demand"]), []),
    (put(ANSWER, ["status"], "maybe"), ["status: domain"]),
    (put(ANSWER, ["answer"], "x" * 1201), ["answer: length"]),
    (put(ANSWER, ["plain_language_explanation"], None), []),
    (put(ANSWER, ["plain_language_explanation"], "x" * 801), ["plain_language_explanation: length"]),
    (put(ANSWER, ["suggested_investigation_areas"], ["x"] * 6), ["suggested_investigation_areas: too_many"]),
    (put(ANSWER, ["suggested_investigation_areas"], ["x" * 161]), ["suggested_investigation_areas[0]: length"]),
    (put(ANSWER, ["claims"], []), ["$: metric_names", "$: supported_facts"]),
    (put(ANSWER, ["status"], "insufficient_context"), ["$: unsupported_facts"]),
    (put(ANSWER, ["source_ids"], ["b"]), ["$: claim_sources"]),
    (put(ANSWER, ["source_ids"], ["a", "a"]), ["$: duplicate_sources"]),
    (put(ANSWER, ["metric_names"], ["revenue", "margin"]), ["$: metric_names"]),
    (put(ANSWER, [*C0, "source_ids"], ["a", "a"]), ["claims[0]: duplicate_sources"]),
    (put(ANSWER, [*C0, "value"], None), ["claims[0]: number_required"]),
    (put(ANSWER, [*C0, "management_explanation_id"], "demand"), ["claims[0]: explanation_forbidden"]),
    (put(put(ANSWER, ["claims"], [{**MANAGED, "value": 1}]), ["metric_names"], ["demand"]), ["claims[0]: numeric_management"]),
    (put(put(ANSWER, ["claims"], [put(MANAGED, ["management_explanation_id"], ...)]), ["metric_names"], ["demand"]),
     ["claims[0]: explanation_required"]),
]


@pytest.mark.parametrize("shape, cases", [(DOC.BRIEFING, BRIEFINGS), (DOC.ANSWER, ANSWERS)], ids=["briefing", "answer"])
def test_shape_rules(spark, shape, cases):
    rows = [(i, json.dumps(doc)) for i, (doc, _) in enumerate(cases)] + [(-1, None), (-2, '{"a":'), (-3, '{"a":1,"a":2}')]
    df = spark.createDataFrame(rows, "id int, response string")
    got = {r["id"]: r for r in DOC.parsed(df, shape).collect()}
    for i, (doc, expected) in enumerate(cases):
        assert got[i]["json_ok"] and got[i]["shape_violations"] == sorted(expected), doc
        assert (got[i]["document"] is not None) == (not expected)
    for i in (-1, -2, -3):
        assert not got[i]["json_ok"] and got[i]["document"] is None and got[i]["shape_violations"] is None


def test_typed_document_is_trimmed_and_exact(spark):
    df = spark.createDataFrame([(json.dumps(BRIEFING),)], "response string")
    d = DOC.parsed(df, DOC.BRIEFING).first()["document"]
    assert d["headline"] == "H" and d["schema_version"] == "1.0" and d["insights"][0]["classification"] == "ai_interpretation"
    assert str(d["insights"][0]["business_claims"][0]["value"]) == "17.750000"
    assert json_schema(DOC.BRIEFING)["properties"]["insights"]["maxItems"] == 6


def test_responses_fail_at_every_stage(spark):
    rows = E.queries()["response_acceptance"](spark, "/root/testdata/sf0.01").collect()
    assert {r["stage"] for r in rows} == {None, "transport", "syntax", "schema", "period", "contract", "claims"}
    assert all(r["accepted"] == (r["stage"] is None) == (r["reason"] is None) for r in rows)


def _rows(spark, rows):
    return spark.createDataFrame([(e, 2026, q, text, "d", "k") for e, q, text in rows], S.SCHEMA)


def _read(spark, base):
    return sorted((r["entity_id"], r["fiscal_period"], r["document"]) for r in S.read(spark, base).collect())


def test_store_replaces_keys_keeps_the_rest_and_has_no_folder_per_entity(spark, tmp_path):
    base = str(tmp_path / "store")
    assert S.read(spark, base).count() == 0
    S.publish(_rows(spark, [(e, "Q1", "a") for e in range(40)]), base, buckets=4)
    S.publish(_rows(spark, [(3, "Q1", "b"), (3, "Q2", "c"), (99, "Q1", "d")]), base)
    expected = sorted([(e, "Q1", "a") for e in range(40) if e != 3] + [(3, "Q1", "b"), (3, "Q2", "c"), (99, "Q1", "d")])
    assert _read(spark, base) == expected
    S.publish(_rows(spark, []), base)
    folders = [p for p in tmp_path.rglob("bucket=*")]
    assert len(folders) <= 4 + 2 and _read(spark, base) == expected
    S.vacuum(spark, base, keep=1)
    assert _read(spark, base) == expected and len(list((tmp_path / "store").glob("manifest-*"))) == 1


def test_concurrent_writers_lose_nothing(spark, tmp_path):
    base = str(tmp_path / "store")
    S.publish(_rows(spark, [(1, "Q1", "a"), (2, "Q1", "a")]), base, buckets=2)
    others = [[(1, "Q1", "other"), (5, "Q1", "other")]]

    def other_writer():
        if others:
            S.publish(_rows(spark, others.pop()), base)

    number = S.publish(_rows(spark, [(2, "Q1", "mine"), (7, "Q1", "mine")]), base, before_commit=other_writer)
    assert number == 3
    assert _read(spark, base) == [(1, "Q1", "other"), (2, "Q1", "mine"), (5, "Q1", "other"), (7, "Q1", "mine")]


def test_unchanged_documents_are_not_evaluated_again(spark):
    figures = "array(named_struct('role','current','period_id','FY2026-Q4','source_id','s','metric','revenue','unit','usd','value',{}))"
    packet = ("named_struct('valid', true, 'sources', array(named_struct('source_id', 'p')), 'explanations', "
              "array(named_struct('explanation_id', 'demand')), 'approved', array(named_struct('metric', 'm', 'value', "
              "cast(1 as decimal(38,6)), 'unit', 'usd', 'classification', 'reported', 'source_ids', array('p'))))")
    base = spark.createDataFrame([(1, "same"), (2, "moved"), (3, "damaged")], "entity_id long, case string").selectExpr(
        "entity_id", "2026 AS fiscal_year", "'Q4' AS fiscal_period", "case", f"{packet} AS packet",
        figures.format("cast(5 as decimal(38,6))") + " AS figures", "'no briefing at all' AS document")
    stored = base.withColumns({"document_digest": F.sha2("document", 256), "knowledge_digest": DOC.knowledge_digest()})
    stored = stored.withColumn("figures", F.when(F.col("case") == "moved", F.expr(figures.format("cast(6 as decimal(38,6))")))
                               .otherwise(F.col("figures")))
    stored = stored.withColumn("document", F.when(F.col("case") == "damaged", "{").otherwise(F.col("document")))
    got = {r["case"]: r for r in DOC.revalidated(stored).collect()}
    # the text would never be accepted, so an approval shows that nobody looked at it again
    assert (got["same"]["reevaluated"], got["same"]["status"]) == (False, "approved")
    assert (got["moved"]["reevaluated"], got["moved"]["status"]) == (True, "malformed")
    assert (got["damaged"]["reevaluated"], got["damaged"]["status"]) == (True, "malformed")


@pytest.mark.parametrize("name", ["briefing_violations", "answer_mode", "briefing_revalidate", "segment_contribution",
                                  "plain_english", "question_route"])
def test_plans_stay_small(spark, name):
    plan = E.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 40 and len(plan) < 500_000
