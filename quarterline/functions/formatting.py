"""Display formatting as column expressions (no UDFs).

``format_number`` rounds the binary double half-even with grouping, which is
what Python's ``f"{x:,.1f}"`` does; ``format_string('%.1f')`` would not.
Decimal formats go through ``bround`` (half-even, as ``Decimal.__format__``)
and a plain decimal-to-string cast.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Display words.
NOT_AVAILABLE = "Not available"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def format_billions(value: Column | str) -> Column:
    """``$1,234.5B``; negative keeps the sign after the dollar (``$-6.3B``)."""
    v = _c(value).cast("double")
    return F.when(v.isNull() | F.isnan(v), F.lit(NOT_AVAILABLE)).otherwise(
        F.concat(F.lit("$"), F.format_number(v / F.lit(1e9), 1), F.lit("B")))


def format_percent(value: Column | str, include_sign: bool = False) -> Column:
    """``12.3%`` (``+12.3%`` with ``include_sign`` for positives)."""
    v = _c(value).cast("double")
    sign = F.when(v > 0, F.lit("+")).otherwise(F.lit("")) if include_sign else F.lit("")
    return F.when(v.isNull() | F.isnan(v), F.lit(NOT_AVAILABLE)).otherwise(
        F.concat(sign, F.format_number(v, 1), F.lit("%")))


def direction_word(value: Column | str, positive: str = "increased", negative: str = "declined") -> Column:
    """Increased / declined / was unchanged / was unavailable."""
    v = _c(value).cast("double")
    return (F.when(v.isNull() | F.isnan(v), F.lit("was unavailable"))
            .when(v > 0, F.lit(positive)).when(v < 0, F.lit(negative)).otherwise(F.lit("was unchanged")))


def tone(value: Column | str) -> Column:
    """Positive / negative / neutral (NULL or zero is neutral)."""
    v = _c(value).cast("double")
    return F.when(v > 0, F.lit("positive")).when(v < 0, F.lit("negative")).otherwise(F.lit("neutral"))


def capitalize(text: Column | str) -> Column:
    """Python ``str.capitalize``: first character upper, the rest lower (not initcap)."""
    t = _c(text)
    return F.concat(F.upper(F.substring(t, 1, 1)), F.lower(F.substring(t, 2, 1 << 30)))


def trim_decimal(value: Column | str) -> Column:
    """Plain decimal text without trailing zeros (``27.50`` -> ``27.5``, ``14`` -> ``14``)."""
    s = _c(value).cast("decimal(38,6)").cast("string")
    return F.when(s.contains("."), F.regexp_replace(F.regexp_replace(s, "0+$", ""), r"\.$", "")).otherwise(s)


def signed_percent(value: Column | str) -> Column:
    """``+14%`` / ``-3.5%`` / ``0%``."""
    v = _c(value).cast("decimal(38,6)")
    return F.concat(F.when(v > 0, F.lit("+")).otherwise(F.lit("")), trim_decimal(v), F.lit("%"))


def signed_billions(value: Column | str) -> Column:
    """``+$9.428B`` / ``-$0.597B`` (sign before the dollar, half-even to 3 places)."""
    # decimal(29,6) / decimal(10,0) keeps 15 fractional digits, i.e. the exact quotient;
    # a wider input would cut the quotient to 6 digits first and round twice
    v = _c(value).cast("decimal(29,6)")
    b = F.bround(F.abs(v) / F.lit(1000000000).cast("decimal(10,0)"), 3).cast("decimal(38,3)").cast("string")
    sign = F.when(v > 0, F.lit("+")).when(v < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, F.lit("$"), b, F.lit("B"))


def percent_2dp(value: Column | str) -> Column:
    """``69.50%`` from a value already rounded to 2 places."""
    return F.concat(_c(value).cast("decimal(38,2)").cast("string"), F.lit("%"))


def count_text(value: Column | str, qualifier: Column | str | None = None) -> Column:
    """``30 million`` for whole millions, else ``1,234,567``; ``More than ...`` for that qualifier."""
    v = _c(value).cast("decimal(38,6)")
    million = F.lit(1000000)
    whole = (v >= million) & (F.pmod(v, million.cast("decimal(38,6)")) == 0)
    shown = F.when(whole, F.concat(trim_decimal((v / million.cast("decimal(10,0)")).cast("decimal(38,6)")), F.lit(" million"))) \
        .otherwise(F.format_number(F.bround(v, 0), 0))
    if qualifier is None:
        return shown
    return F.when(_c(qualifier) == "more_than", F.concat(F.lit("More than "), shown)).otherwise(shown)
