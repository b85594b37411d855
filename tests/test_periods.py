"""Column helpers against plain-Python versions of the same rules (brute force)."""

import datetime as dt

from pyspark.sql import functions as F

from quarterline.functions import periods as P


def py_fiscal_year(d):
    return d.year + 1 if d.month in (9, 12) else d.year if d.month in (3, 6) else None


def py_fiscal_period(d):
    return {9: "Q1", 12: "Q2", 3: "Q3"}.get(d.month)


def test_fiscal_year_and_period_every_month(spark):
    days = [dt.date(2020, m, 15) for m in range(1, 13)] + [dt.date(2025, 6, 30), dt.date(2025, 9, 30)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    rows = df.select("d", P.fiscal_year_of("d").alias("fy"), P.fiscal_period_of("d").alias("fp")).collect()
    for r in rows:
        assert r.fy == py_fiscal_year(r.d)
        assert r.fp == py_fiscal_period(r.d)


def test_duration_and_class(spark):
    cases = [("2024-07-01", "2024-09-30"), ("2024-07-01", "2025-03-31"), ("2024-07-01", "2025-06-30"),
             ("2024-07-01", "2024-12-31"), (None, "2025-06-30"), ("2024-07-01", "2024-07-10")]
    df = spark.createDataFrame(cases, "s string, e string")
    out = df.select(P.duration_days(P.iso_date("s"), P.iso_date("e")).alias("d"),
                    P.duration_between(P.iso_date("s"), P.iso_date("e"), 80, 100).alias("q"),
                    P.duration_class(P.iso_date("s"), P.iso_date("e")).alias("c")).collect()
    assert [r.d for r in out] == [92, 274, 365, 184, None, 10]
    assert [r.q for r in out] == [True, False, False, False, False, False]
    assert [r.c for r in out] == ["Quarter", "Nine Months", "Full Year", "Six Months", "Instant", "Other"]


def test_iso_date_rejects_compact_form(spark):
    df = spark.createDataFrame([("2026-06-30",), ("20260630",), ("2026-13-01",)], "t string")
    assert [r[0] for r in df.select(P.iso_date("t")).collect()] == [dt.date(2026, 6, 30), None, None]


def test_period_parse_is_strict(spark):
    texts = ["FY2026-Q4", "fy2026-Q4", "FY2026-Q5", "FY1899-Q1", " FY2026-Q4", "FY2026-Q4 ", "FY9999-Q1"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(P.parse_period("t")).collect()]
    assert got[0].fiscal_year == 2026 and got[0].fiscal_period == "Q4"
    assert got[1:6] == [None] * 5
    assert got[6].fiscal_year == 9999


def test_quarter_dates_and_ordinals(spark):
    df = spark.createDataFrame([(2026, q) for q in (1, 2, 3, 4)], "fy int, q int")
    out = df.select(P.quarter_start("fy", "q").alias("s"), P.quarter_end("fy", "q").alias("e"),
                    P.quarter_number(F.concat(F.lit("Q"), F.col("q").cast("string"))).alias("n")).collect()
    assert [(r.s, r.e) for r in out] == [
        (dt.date(2025, 7, 1), dt.date(2025, 9, 30)), (dt.date(2025, 10, 1), dt.date(2025, 12, 31)),
        (dt.date(2026, 1, 1), dt.date(2026, 3, 31)), (dt.date(2026, 4, 1), dt.date(2026, 6, 30))]
    assert [r.n for r in out] == [1, 2, 3, 4]
