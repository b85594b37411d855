"""Segment reconciliation, contribution shares and ranking against the published ranking."""

from decimal import Decimal

from pyspark.sql import functions as F

from quarterline.operators import drivers as D

K = (1, 2026, "Q4")
# Published FY2026 Q4 segment revenue (current, prior year).
SEGMENTS = [("Segment A", 37847000000, 33112000000),
            ("Segment B", 39306000000, 29878000000),
            ("Segment C", 12854000000, 13451000000)]
FACTS = [("revenue", 90007000000), ("prior_year_quarter_revenue", 76441000000), ("revenue_increase", 13566000000)]


def packet(spark, facts=FACTS, extra_source=False, derived=0):
    key = "entity_id bigint, fiscal_year int, fiscal_period string"
    head = spark.createDataFrame([(*K, derived)], key + ", derived_metric_count int")
    sources = spark.createDataFrame([(*K, "press", 2026, "Q4", "press_release", "t", "https://x/1")],
                                    key + ", source_id string, source_fiscal_year int, source_fiscal_period string, "
                                          "source_type string, title string, url string")
    f = spark.createDataFrame([(*K, "reported_fact", i, m, "L", Decimal(v), "usd", "reported",
                                ["press", "ghost"] if extra_source and i == 0 else ["press"])
                               for i, (m, v) in enumerate(facts)],
                              key + ", kind string, pos int, metric string, label string, value decimal(38,6), "
                                    "unit string, classification string, source_ids array<string>").withColumn("qualifier", F.lit("exact"))
    segs = spark.createDataFrame([(*K, s, c, p, Decimal(0), "reported", ["press"]) for s, c, p in SEGMENTS],
                                 key + ", segment string, current_revenue bigint, prior_year_revenue bigint, "
                                       "reported_growth_pct decimal(38,6), classification string, "
                                       "source_ids array<string>")
    expl = spark.createDataFrame([(*K, "demand", "s", "Entity management", "management_explanation", ["press"])],
                                 key + ", explanation_id string, statement string, attribution string, "
                                       "classification string, source_ids array<string>")
    return D.nest({"head": head, "sources": sources, "facts": f, "segments": segs, "explanations": expl})


def test_published_contributions_and_ranking(spark):
    p = packet(spark)
    recon = D.reconciliation(p)
    r = recon.collect()[0]
    assert r.valid and r.change_total == 13566000000
    contrib = {x.segment: x for x in D.contributions(p).collect()}
    assert contrib["Segment B"].absolute_revenue_change == 9428000000
    assert contrib["Segment B"].contribution_pct == 69.50
    assert contrib["Segment A"].contribution_pct == 34.90
    assert contrib["Segment C"].contribution_pct == -4.40
    rank = D.ranking(p).orderBy("direction", "rank").collect()
    assert [(x.direction, x.segment) for x in rank] == [
        ("negative", "Segment C"), ("positive", "Segment B"),
        ("positive", "Segment A")]


def test_first_failing_rule_and_exact_reconciliation(spark):
    off_by_one = [(m, v + (1 if m == "revenue" else 0)) for m, v in FACTS]
    r = D.reconciliation(packet(spark, facts=off_by_one)).collect()[0]
    assert not r.valid and r.current_mismatch and not r.change_mismatch
    assert r.first_violation.startswith("Segment current revenue")
    r = D.reconciliation(packet(spark, extra_source=True, derived=1)).collect()[0]
    assert r.first_violation.startswith("Unsupported source IDs")
    assert r.derived_stored and r.violations.count(".") >= 2
    missing = D.reconciliation(packet(spark, facts=FACTS[:2])).collect()[0]
    assert missing.missing_facts and not missing.current_mismatch


def test_orphans_and_slug(spark):
    p = packet(spark, extra_source=True)
    assert [r.source_id for r in D.orphan_sources(p).collect()] == ["ghost"]
    df = spark.createDataFrame([("Devices & Gaming",), ("  Home   Office\tDevices ",)], "s string")
    got = [r[0] for r in df.select(D.segment_metric(F.col("s"), "current_revenue")).collect()]
    assert got == ["segment.devices_and_gaming.current_revenue",
                   "segment.home_office_devices.current_revenue"]


def test_packet_json_round_trip_and_strictness(spark, tmp_path):
    from quarterline.plans.catalog import Fixtures
    from quarterline.sources import packets_json as PJ

    from conftest import SMALL

    p = Fixtures(spark, SMALL).packets
    extra = (F.col("entity_id") % 3 == 2) & (F.col("fiscal_period") == "Q1")
    docs = PJ.packets_to_json(p, extra_field=extra)
    path = str(tmp_path / "packets")
    docs.select("json").write.text(path)
    parsed = PJ.strict_parse(PJ.read_packets(spark, path, whole_file=False))
    assert parsed.where("malformed").count() == 0
    flagged = parsed.where("size(unknown_fields) > 0")
    assert flagged.count() == docs.where(extra).count()
    assert {r[0] for r in flagged.select(F.array_join("unknown_fields", ",")).collect()} == {"reviewer_note"}
    back = PJ.parsed_packets(parsed)
    a = D.reconciliation(back).drop("derived_stored", "violations", "first_violation", "valid")
    b = D.reconciliation(p).drop("derived_stored", "violations", "first_violation", "valid")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_record_rules_of_scanned_packets(spark):
    from quarterline.sources import packets_json as PJ

    text = ('{"schema_version":"2.0","entity_id":1,"reporting_period":{"fiscal_year":2026,"fiscal_period":"Q4"},"sources":[],'
            '"reported_facts":[{"metric":"revenue","label":" ","value":"1.5","unit":"usd","classification":"reported",'
            '"source_ids":["a"],"qualifier":"more_than"}],"segment_results":[{"segment":"A","current_revenue":"1.5",'
            '"prior_year_revenue":"1","reported_growth_pct":"50","classification":"reported","source_ids":["a"]}],'
            '"product_indicators":[{"metric":"m","label":"M","value":"30000000","unit":"count","classification":"reported",'
            '"source_ids":["a"],"qualifier":"nearly"}],"derived_metrics":[],"management_explanations":[]}')
    parsed = PJ.strict_parse(spark.createDataFrame([("FY2026-Q4.json", text)], "file_name string, json string"))
    packets = PJ.parsed_packets(parsed)
    r = D.schema_violations(packets, "https://x/", "Entity management").first()
    assert (r.seg_non_integer, r.missing_value, r.bad_qualifier, r.bad_version, r.empty_records, r.non_integer_value) == (1, 1, 1, 1, 2, 1)
    assert D.child(packets, "facts").where("qualifier = 'more_than'").count() == 1
