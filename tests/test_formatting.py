"""Formatted strings against Python's own formatting of the same values."""

from decimal import Decimal

from pyspark.sql import functions as F

from quarterline.functions import formatting as fmt

VALUES = [0.25, 0.35, 12.35, -6.3e9, 90007000000.0, 1234567890123.0, 0.0, -0.05, 8.59, 17.75, 45.11, 99.95]


def test_billions_and_percent_match_python(spark):
    df = spark.createDataFrame([(v,) for v in VALUES] + [(None,)], "v double")
    out = df.select("v", fmt.format_billions("v").alias("b"), fmt.format_percent("v").alias("p"),
                    fmt.format_percent("v", include_sign=True).alias("ps")).collect()
    for r in out:
        if r.v is None:
            assert r.b == r.p == r.ps == "Not available"
            continue
        assert r.b == f"${r.v / 1_000_000_000:,.1f}B"
        assert r.p == f"{r.v:,.1f}%"
        assert r.ps == ("+" if r.v > 0 else "") + f"{r.v:,.1f}%"


def test_signed_and_trimmed(spark):
    vals = ["9428000000", "-597000000", "0", "27.50", "14", "-3.250"]
    df = spark.createDataFrame([(Decimal(v),) for v in vals], "v decimal(38,6)")
    out = df.select(fmt.signed_billions("v").alias("b"), fmt.signed_percent("v").alias("p"),
                    fmt.trim_decimal("v").alias("t")).collect()
    assert [r.b for r in out][:3] == ["+$9.428B", "-$0.597B", "$0.000B"]
    assert [r.t for r in out] == ["9428000000", "-597000000", "0", "27.5", "14", "-3.25"]
    assert out[3].p == "+27.5%" and out[5].p == "-3.25%"


def test_direction_tone_capitalize(spark):
    df = spark.createDataFrame([(1.0, "gross margin improved"), (-2.0, "NET margin"), (0.0, "x"), (None, "")],
                               "v double, t string")
    out = df.select(fmt.direction_word("v").alias("d"), fmt.tone("v").alias("o"),
                    fmt.capitalize(F.col("t")).alias("c")).collect()
    assert [r.d for r in out] == ["increased", "declined", "was unchanged", "was unavailable"]
    assert [r.o for r in out] == ["positive", "negative", "neutral", "neutral"]
    assert [r.c for r in out] == ["Gross margin improved", "Net margin", "X", ""]


def test_signed_billions_rounds_once(spark):
    vals = ["-40500200", "40500000", "41500000", "637500001", "-117500000"]
    df = spark.createDataFrame([(Decimal(v),) for v in vals], "v decimal(38,6)")
    got = [r[0] for r in df.select(fmt.signed_billions("v")).collect()]
    want = []
    for v in vals:
        b = Decimal(v) / Decimal("1000000000")
        want.append(("+" if b > 0 else "-" if b < 0 else "") + f"${abs(b):.3f}B")
    assert got == want
