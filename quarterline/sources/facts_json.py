"""A1: nested company-facts documents -> one row per observation.

Document shape (JSON, one document per line or one per file)::

    {"entity_id": 7,
     "facts": {"us-gaap": {"<Concept>": {"label": ..., "description": ...,
               "units": {"USD": [{"start", "end", "val", "accn", "fy", "fp",
                                  "form", "filed"}, ...]}}}}}

Parsed with an explicit schema (no inference), then exploded taxonomy ->
concept -> unit -> observation; ``posexplode`` keeps each observation's array
position, which is the "first seen" tie-break of the latest-filed rule.
Concept filtering happens right after the concept explode, so unused
concepts never reach the observation explode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterline.functions.metrics import CONCEPT_OF_METRIC

OBSERVATION = T.StructType([
    T.StructField("start", T.StringType()),
    T.StructField("end", T.StringType()),
    T.StructField("val", T.DecimalType(38, 4)),
    T.StructField("accn", T.StringType()),
    T.StructField("fy", T.StringType()),
    T.StructField("fp", T.StringType()),
    T.StructField("form", T.StringType()),
    T.StructField("filed", T.StringType()),
])
CONCEPT = T.StructType([
    T.StructField("label", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("units", T.MapType(T.StringType(), T.ArrayType(OBSERVATION))),
])
DOCUMENT = T.StructType([
    T.StructField("entity_id", T.LongType()),
    T.StructField("facts", T.MapType(T.StringType(), T.MapType(T.StringType(), CONCEPT))),
])

TAXONOMY = "us-gaap"


def read_documents(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """Raw JSON text -> (doc_id, json). ``whole_file`` for one document per file."""
    text = spark.read.text(path, wholetext=whole_file)
    return text.select(F.col("_metadata.file_path").alias("doc_id"), F.col("value").alias("json"))


def explode_documents(docs: DataFrame, concepts: list[str] | None = None) -> DataFrame:
    """(…, json) -> one row per observation of the wanted concepts.

    Output: entity_id, concept, label, unit, pos, start_date, end_date, val,
    accn, fy, fp, form, filed.  A document that fails to parse and a concept
    absent from a document yield no rows here; ``document_report`` names them.
    """
    wanted = concepts if concepts is not None else list(CONCEPT_OF_METRIC.values())
    parsed = docs.select(F.from_json("json", DOCUMENT).alias("d")).where(F.col("d").isNotNull())
    tax = parsed.select(F.col("d.entity_id").alias("entity_id"),
                        F.element_at(F.col("d.facts"), F.lit(TAXONOMY)).alias("concepts"))
    concept_rows = tax.select("entity_id", F.explode(
        F.map_filter("concepts", lambda k, v: k.isin(*wanted))).alias("concept", "c"))
    unit_rows = concept_rows.select("entity_id", "concept", F.col("c.label").alias("label"),
                                    F.explode("c.units").alias("unit", "observations"))
    obs = unit_rows.select("entity_id", "concept", "label", "unit",
                           F.posexplode("observations").alias("pos", "o"))
    return obs.select(
        "entity_id", "concept", "label", "unit", F.col("pos").cast("int").alias("pos"),
        F.col("o.start").alias("start_date"), F.col("o.end").alias("end_date"),
        F.col("o.val").alias("val"), F.col("o.accn").alias("accn"),
        F.col("o.fy").alias("fy"), F.col("o.fp").alias("fp"),
        F.col("o.form").alias("form"), F.col("o.filed").alias("filed"),
    )


def read_document_lines(spark: SparkSession, path: str) -> DataFrame:
    """Landed documents, one ``{"doc_id", "json"}`` envelope per line; a line that is no envelope keeps its text in ``_corrupt_record``."""
    return spark.read.schema("doc_id string, json string, _corrupt_record string").json(path)


def document_report(docs: DataFrame, expected: DataFrame, concepts: list[str] | None = None) -> DataFrame:
    """A1: what became of every expected document: ok, malformed or missing.

    ``docs``: doc_id, json.  ``expected``: doc_id.  Per document its status,
    the wanted concepts it lacks (sorted), its observations of the others and
    how many of their values are no whole numbers and so are no facts.
    """
    wanted = sorted(concepts if concepts is not None else CONCEPT_OF_METRIC.values())
    # a broken document parses to a struct of nulls, which has no facts
    parsed = docs.select("doc_id", F.from_json("json", DOCUMENT)["facts"].alias("f"), F.lit(True).alias("_there"))
    found = F.map_filter(F.element_at("f", F.lit(TAXONOMY)), lambda k, v: k.isin(*wanted))
    values = F.flatten(F.transform(F.map_values("_found"), lambda c: F.flatten(F.map_values(c["units"]))))
    x = expected.join(parsed, "doc_id", "left").withColumn("_found", found)
    x = x.withColumn("_obs", values)
    ok = F.col("f").isNotNull()
    fractions = F.size(F.filter("_obs", lambda o: o["val"] != F.floor(o["val"])))
    return x.select(
        "doc_id", F.when(F.col("_there").isNull(), "missing").when(ok, "ok").otherwise("malformed").alias("status"),
        F.when(ok, F.array_except(F.array(*[F.lit(w) for w in wanted]), F.map_keys("_found"))).alias("missing_concepts"),
        F.when(ok, F.size("_obs")).cast("bigint").alias("observations"), F.when(ok, fractions).cast("bigint").alias("fractional_values"))


def documents_from_observations(obs: DataFrame) -> DataFrame:
    """Fixture writer: fx_obs rows -> JSON documents, one per (entity, fy).

    Each document is bounded by one filing year of one entity, so no document
    grows with the data.  Observations are ordered by (end_date, seq).
    """
    per_concept = obs.groupBy("entity_id", "fy", "concept", "unit").agg(
        F.array_sort(F.collect_list(F.struct(
            F.col("end_date").alias("_k1"), F.col("seq").alias("_k2"),
            F.struct(F.col("start_date").alias("start"), F.col("end_date").alias("end"), "val", "accn",
                     F.col("fy").cast("string").alias("fy"), "fp", "form", "filed").alias("o"),
        ))).alias("arr")
    )
    per_concept = per_concept.select(
        "entity_id", "fy", "concept",
        F.struct(F.col("concept").alias("label"), F.lit("Fixture facts").alias("description"),
                 F.create_map(F.col("unit"), F.transform("arr", lambda x: x["o"])).alias("units")).alias("c"),
    )
    docs = per_concept.groupBy("entity_id", "fy").agg(
        F.map_from_entries(F.collect_list(F.struct("concept", "c"))).alias("concepts"))
    return docs.select(
        F.concat_ws("-", F.col("entity_id").cast("string"), F.col("fy").cast("string")).alias("doc_id"),
        F.to_json(F.struct("entity_id", F.create_map(F.lit(TAXONOMY), F.col("concepts")).alias("facts"))).alias("json"),
    )
