"""A5: strict approved-packet JSON scan.

One JSON document per packet (``read.text(dir, wholetext=True)`` for one file
per period, or JSON lines).  Parsing uses an explicit schema; strictness --
no fields beyond the schema -- is checked with ``json_object_keys`` at the
top level and inside every record (``from_json`` alone silently drops unknown
fields).  The period named by the file must equal the packet's own period.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PERIOD = T.StructType([T.StructField("fiscal_year", T.IntegerType()), T.StructField("fiscal_period", T.StringType())])
SOURCE = T.StructType([T.StructField("source_id", T.StringType()), T.StructField("reporting_period", PERIOD),
                       T.StructField("source_type", T.StringType()), T.StructField("title", T.StringType()),
                       T.StructField("url", T.StringType())])
FACT = T.StructType([T.StructField("metric", T.StringType()), T.StructField("label", T.StringType()),
                     T.StructField("value", T.StringType()), T.StructField("unit", T.StringType()),
                     T.StructField("classification", T.StringType()),
                     T.StructField("source_ids", T.ArrayType(T.StringType())),
                     T.StructField("qualifier", T.StringType())])
SEGMENT = T.StructType([T.StructField("segment", T.StringType()), T.StructField("current_revenue", T.StringType()),
                        T.StructField("prior_year_revenue", T.StringType()),
                        T.StructField("reported_growth_pct", T.StringType()),
                        T.StructField("classification", T.StringType()),
                        T.StructField("source_ids", T.ArrayType(T.StringType()))])
EXPLANATION = T.StructType([T.StructField("explanation_id", T.StringType()), T.StructField("statement", T.StringType()),
                            T.StructField("attribution", T.StringType()),
                            T.StructField("classification", T.StringType()),
                            T.StructField("source_ids", T.ArrayType(T.StringType()))])
PACKET = T.StructType([
    T.StructField("schema_version", T.StringType()), T.StructField("entity_id", T.LongType()),
    T.StructField("reporting_period", PERIOD), T.StructField("sources", T.ArrayType(SOURCE)),
    T.StructField("reported_facts", T.ArrayType(FACT)), T.StructField("segment_results", T.ArrayType(SEGMENT)),
    T.StructField("product_indicators", T.ArrayType(FACT)), T.StructField("derived_metrics", T.ArrayType(FACT)),
    T.StructField("management_explanations", T.ArrayType(EXPLANATION)),
])
TOP_KEYS = [f.name for f in PACKET.fields]
RECORD_KEYS = {"sources": [f.name for f in SOURCE.fields], "reported_facts": [f.name for f in FACT.fields],
               "segment_results": [f.name for f in SEGMENT.fields],
               "product_indicators": [f.name for f in FACT.fields],
               "management_explanations": [f.name for f in EXPLANATION.fields]}
REQUIRED = ["schema_version", "entity_id", "reporting_period.fiscal_year", "reporting_period.fiscal_period", "sources",
            "reported_facts", "segment_results"]
CORRUPT = "_corrupt_record"
FILE_PERIOD = r"FY(\d{4})-(Q[1-4])"


def read_packets(spark: SparkSession, path: str, whole_file: bool = True) -> DataFrame:
    """Raw packet documents with the file they came from."""
    text = spark.read.text(path, wholetext=whole_file)
    return text.select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("json"))


def _unknown(keys: Column, allowed: list[str]) -> Column:
    return F.array_except(F.coalesce(keys, F.array().cast("array<string>")), F.array(*[F.lit(k) for k in allowed]))


def strict_parse(docs: DataFrame) -> DataFrame:
    """(file_name?, json) -> parsed packet + strictness verdicts per document.

    Adds: ``malformed`` (not a complete JSON object of the schema: truncated,
    another JSON type, a field of the wrong type or a required field missing;
    its packet is NULL), ``unknown_fields`` (sorted list of
    fields outside the schema, top level and records) and ``period_matches``
    (the ``FYyyyy-Qn`` in the file name equals the packet period, when a file
    name is present).
    """
    checked = T.StructType([*PACKET.fields, T.StructField(CORRUPT, T.StringType())])
    raw = F.from_json("json", checked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    top = _unknown(F.json_object_keys("json"), TOP_KEYS)
    record_unknown = []
    for field, allowed in RECORD_KEYS.items():
        items = F.from_json(F.get_json_object("json", f"$.{field}"), T.ArrayType(T.StringType()))
        per_item = F.transform(F.coalesce(items, F.array().cast("array<string>")),
                               lambda x: _unknown(F.json_object_keys(x), allowed))
        record_unknown.append(F.transform(F.flatten(per_item), lambda k: F.concat(F.lit(field + "."), k)))
    unknown = F.array_sort(F.array_distinct(F.concat(top, *record_unknown)))
    cols = docs.columns
    fname = F.col("file_name") if "file_name" in cols else F.lit(None).cast("string")
    complete = F.lit(True)
    for name in REQUIRED:
        complete = complete & F.col("_raw." + name).isNotNull()
    broken = F.coalesce(~F.col("json").rlike(r"^\s*\{") | F.col("_raw").isNull() | F.col("_raw." + CORRUPT).isNotNull() | ~complete, F.lit(True))
    packet = F.struct(*[F.col("_raw." + name).alias(name) for name in TOP_KEYS])
    out = (docs.withColumn("_raw", raw).withColumn("malformed", broken)
           .select(*cols, F.when(~F.col("malformed"), packet).alias("packet"), "malformed",
                   F.when(~F.col("malformed"), unknown).otherwise(F.array().cast("array<string>")).alias("unknown_fields")))
    period = F.col("packet.reporting_period")
    file_fy = F.regexp_extract(fname, FILE_PERIOD, 1).try_cast("int")
    file_fp = F.regexp_extract(fname, FILE_PERIOD, 2)
    same = F.coalesce((file_fy == period["fiscal_year"]) & (file_fp == period["fiscal_period"]), F.lit(False))
    return out.select(*cols, "packet", "unknown_fields", "malformed",
                      (~F.col("malformed") & F.when(fname.isNull(), F.lit(True)).otherwise(same)).alias("period_matches"))


def packets_to_json(packets: DataFrame, extra_field: Column | None = None) -> DataFrame:
    """Packet rows -> one JSON document each, with the file name of its period.

    ``extra_field`` (a boolean column over the packet key) adds a field that
    is not in the schema, for the strictness check to find.
    """
    keys = ["entity_id", "fiscal_year", "fiscal_period"]

    def period(fy: Column, fp: Column) -> Column:
        return F.struct(fy.alias("fiscal_year"), fp.alias("fiscal_period"))

    def facts(kind: str) -> Column:
        return F.transform(F.filter("facts", lambda f: f["kind"] == kind), lambda f: F.struct(
            f["metric"].alias("metric"), f["label"].alias("label"), f["value"].cast("string").alias("value"),
            f["unit"].alias("unit"), f["classification"].alias("classification"), f["source_ids"].alias("source_ids"),
            f["qualifier"].alias("qualifier")))

    sources = F.transform("sources", lambda s: F.struct(
        s["source_id"].alias("source_id"), period(s["source_fiscal_year"], s["source_fiscal_period"]).alias("reporting_period"),
        s["source_type"].alias("source_type"), s["title"].alias("title"), s["url"].alias("url")))
    segments = F.transform("segments", lambda s: F.struct(
        s["segment"].alias("segment"), *[s[c].cast("string").alias(c) for c in (
            "current_revenue", "prior_year_revenue", "reported_growth_pct")],
        s["classification"].alias("classification"), s["source_ids"].alias("source_ids")))
    doc = F.struct(
        F.lit("1.0").alias("schema_version"), F.col("entity_id"),
        period(F.col("fiscal_year"), F.col("fiscal_period")).alias("reporting_period"), sources.alias("sources"),
        facts("reported_fact").alias("reported_facts"), segments.alias("segment_results"),
        facts("product_indicator").alias("product_indicators"),
        F.array().cast(T.ArrayType(FACT)).alias("derived_metrics"), F.col("explanations").alias("management_explanations"))
    text = F.to_json(doc)
    if extra_field is not None:
        text = F.when(extra_field, F.regexp_replace(text, r"\}$", ',"reviewer_note":"draft"}')).otherwise(text)
    return packets.select(*keys, F.concat(F.lit("FY"), F.col("fiscal_year").cast("string"), F.lit("-"),
                                          F.col("fiscal_period"), F.lit(".json")).alias("file_name"), text.alias("json"))


def parsed_packets(parsed: DataFrame) -> DataFrame:
    """Well-formed parsed packets as packet rows, keyed by the packet's own period.

    Decimal text goes through ``try_cast``: bad text is NULL.  Segment revenue
    stays DECIMAL, so that fractions reach the integer rule.
    """
    pk = F.col("packet")
    dec = lambda c: c.try_cast("decimal(38,6)")

    def none(kind: T.ArrayType) -> Column:
        return F.array().cast(kind)

    def facts(field: str, kind: str) -> Column:
        return F.transform(F.coalesce(pk[field], none(T.ArrayType(FACT))), lambda f, i: F.struct(
            F.lit(kind).alias("kind"), i.cast("int").alias("pos"), f["metric"].alias("metric"), f["label"].alias("label"),
            dec(f["value"]).alias("value"), f["unit"].alias("unit"), f["classification"].alias("classification"),
            f["source_ids"].alias("source_ids"), F.coalesce(f["qualifier"], F.lit("exact")).alias("qualifier")))

    return parsed.where(~F.col("malformed")).select(
        pk["entity_id"].alias("entity_id"), pk["reporting_period"]["fiscal_year"].alias("fiscal_year"),
        pk["reporting_period"]["fiscal_period"].alias("fiscal_period"), pk["schema_version"].alias("schema_version"),
        F.size(F.coalesce(pk["derived_metrics"], none(T.ArrayType(FACT)))).alias("derived_metric_count"),
        F.transform(F.coalesce(pk["sources"], none(T.ArrayType(SOURCE))), lambda s: F.struct(
            s["source_id"].alias("source_id"), s["reporting_period"]["fiscal_year"].alias("source_fiscal_year"),
            s["reporting_period"]["fiscal_period"].alias("source_fiscal_period"), s["source_type"].alias("source_type"),
            s["title"].alias("title"), s["url"].alias("url"))).alias("sources"),
        F.concat(facts("reported_facts", "reported_fact"), facts("product_indicators", "product_indicator")).alias("facts"),
        F.transform(F.coalesce(pk["segment_results"], none(T.ArrayType(SEGMENT))), lambda s: F.struct(
            s["segment"].alias("segment"), *[dec(s[c]).alias(c) for c in (
                "current_revenue", "prior_year_revenue", "reported_growth_pct")],
            s["classification"].alias("classification"), s["source_ids"].alias("source_ids"))).alias("segments"),
        F.coalesce(pk["management_explanations"], none(T.ArrayType(EXPLANATION))).alias("explanations"))
