"""File scans: broken, missing and fractional documents, and contracted CSV files."""

import pytest

from quarterline.operators import observations as O
from quarterline.sources import exports as X
from quarterline.sources import facts_json as J

OBS = ('{"start":"2025-07-01","end":"2025-09-30","val":%s,"accn":"a","fy":"2026","fp":"Q1","form":"10-Q","filed":"2025-10-20"}')
DOC = '{"entity_id":1,"facts":{"us-gaap":{"%s":{"label":"L","description":"D","units":{"USD":[%s]}}}}}'


def test_every_expected_document_gets_a_row(spark, tmp_path):
    concepts = ["Revenues", "NetIncomeLoss"]
    whole = DOC % ("Revenues", ",".join(OBS % v for v in (5, 6)))
    rows = [("whole", whole), ("cut", whole[:40]), ("fraction", DOC % ("Revenues", OBS % "5.5")), ("list", "[1]"), ("other", DOC % ("X", OBS % 1))]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id string, json string").write.json(path)
    with open(tmp_path / "docs" / "extra.json", "w") as f:
        f.write("not an envelope\n")
    docs = J.read_document_lines(spark, path)
    assert docs.where("doc_id is null and _corrupt_record is not null").count() == 1
    expected = spark.createDataFrame([(n,) for n, _ in rows] + [("never",)], "doc_id string")
    got = {r["doc_id"]: tuple(r)[1:] for r in J.document_report(docs.where("doc_id is not null"), expected, concepts).collect()}
    assert got == {"whole": ("ok", ["NetIncomeLoss"], 2, 0), "cut": ("malformed", None, None, None),
                   "fraction": ("ok", ["NetIncomeLoss"], 1, 1), "list": ("malformed", None, None, None),
                   "other": ("ok", ["NetIncomeLoss", "Revenues"], 0, 0), "never": ("missing", None, None, None)}


@pytest.mark.parametrize("value, facts", [("5", 1), ("5.0000", 1), ("5.5", 0)])
def test_a_fraction_is_not_cut_to_a_fact(spark, value, facts):
    from quarterline.functions.metrics import CONCEPT_OF_METRIC

    docs = spark.createDataFrame([("d", DOC % (CONCEPT_OF_METRIC["revenue"], OBS % value))], "doc_id string, json string")
    assert O.classify(J.explode_documents(docs), position="pos").count() == facts


def test_contracted_scan_states(spark, tmp_path):
    def scan(name, text):
        if text is not None:
            (tmp_path / name).write_text(text)
        rows, report = X.scan_export(spark, str(tmp_path / name), ["fiscal_year", "revenue"], ["fiscal_year"])
        return rows is not None, tuple(report.first())

    assert scan("none.csv", None) == (False, ("missing_file", "", 0, 0))
    assert scan("whole.csv", "fiscal_year,revenue,more\n2026,1,x\n") == (True, ("ok", "", 1, 0))
    assert scan("column.csv", "fiscal_year\n2026\n") == (True, ("missing_columns", "revenue", 1, 0))
    assert scan("empty.csv", "fiscal_year,revenue\n") == (True, ("empty", "", 0, 0))
    assert scan("bad.csv", "fiscal_year,revenue\n2026,1\nn/a,2\n,3\n") == (True, ("bad_rows", "", 3, 2))
