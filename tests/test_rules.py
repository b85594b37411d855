"""Every rule of the packet and figure checks fails somewhere and holds somewhere."""

import __spark_entry__ as E

SF = "/root/testdata/sf0.01"
RECON = ["duplicate_sources", "source_period", "unsupported_sources", "missing_facts", "current_mismatch", "prior_mismatch",
         "change_mismatch", "valid"]
COUNTS = {"packet_violations": ["bad_classification", "non_integer_value", "bad_source_list", "seg_bad_classification",
                                "seg_bad_source_list", "bad_url", "bad_source_type", "bad_explanation"],
          "grounded_figure_rules": ["bad_units", "non_integral", "bad_source_ids", "violations"]}


def test_reconciliation_flags_take_both_values(spark):
    rows = E.queries()["segment_reconcile"](spark, SF).collect()
    for flag in RECON:
        assert {r[flag] for r in rows} == {True, False}, flag


def test_rule_counts_take_zero_and_more(spark):
    for name, columns in COUNTS.items():
        rows = E.queries()[name](spark, SF).collect()
        for c in columns:
            assert any(r[c] for r in rows) and any(not r[c] for r in rows), (name, c)


def test_broken_packet_documents_are_seen(spark):
    rows = E.queries()["packet_json_scan"](spark, SF).collect()
    assert {r["malformed"] for r in rows} == {True, False}
    assert all(r["entity_id"] is None and not r["period_matches"] for r in rows if r["malformed"])
