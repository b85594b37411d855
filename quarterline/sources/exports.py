"""Contract-checked exports and document sinks.

* ``contract_report`` (A3 / A8 / I10): per export, required columns present,
  rows, non-empty, "exactly one latest row per entity", and the loader's
  scoped row count -- one small aggregate per export, no data to the driver.
* ``publish_exports`` (A8): write every export to a staging folder, check all
  of them, and only then move them into place (all or none).
* ``write_csv`` (A7): processed-facts CSV with a fixed column order.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Required columns of each export.
ANALYTICS_COLUMNS = ["fiscal_year", "fiscal_period", "quarter_number", "revenue", "gross_profit", "operating_income",
                     "net_income", "previous_quarter_revenue", "prior_year_quarter_revenue", "revenue_qoq_change",
                     "revenue_qoq_growth_pct", "revenue_yoy_change", "revenue_yoy_growth_pct", "gross_margin_pct",
                     "operating_margin_pct", "net_margin_pct"]
EXPORT_COLUMNS = {
    "latest_quarter": ANALYTICS_COLUMNS,
    "quarterly_analytics": ANALYTICS_COLUMNS,
    "annual_financials": ["fiscal_year", "revenue", "gross_profit", "operating_income", "net_income",
                          "prior_year_revenue", "revenue_yoy_change", "revenue_yoy_growth_pct", "gross_margin_pct",
                          "operating_margin_pct", "net_margin_pct", "operating_income_yoy_growth_pct",
                          "net_income_yoy_growth_pct"],
    "quarterly_financials": ["fiscal_year", "fiscal_period", "revenue", "gross_profit", "operating_income",
                             "net_income"],
}
ONE_PER_ENTITY = {"latest_quarter"}
FACT_CSV_COLUMNS = ["metric", "sec_metric", "start_date", "end_date", "fiscal_year", "fiscal_period", "value", "form",
                    "filed_date", "accession_number"]


def contract_report(frames: dict[str, DataFrame], min_fiscal_year: int) -> DataFrame:
    """One row per export: missing columns, rows, entities, per-entity rule, scoped rows, ok."""
    parts = []
    for name, required in EXPORT_COLUMNS.items():
        df = frames[name]
        missing = sorted(set(required) - set(df.columns))
        per_entity = df.groupBy("entity_id").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.when(F.col("fiscal_year") >= min_fiscal_year, 1).otherwise(0)).alias("s"))
        agg = per_entity.agg(
            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"),
            F.count(F.lit(1)).cast("bigint").alias("entities"),
            F.coalesce(F.max("n"), F.lit(0)).cast("bigint").alias("max_rows_per_entity"),
            F.coalesce(F.sum("s"), F.lit(0)).cast("bigint").alias("scoped_rows"))
        one_rule = (F.col("max_rows_per_entity") == 1) if name in ONE_PER_ENTITY else F.lit(True)
        parts.append(agg.select(
            F.lit(name).alias("export_name"),
            F.lit(", ".join(missing)).alias("missing_columns"),
            "rows", "entities", "max_rows_per_entity", "scoped_rows",
            one_rule.alias("row_rule_ok"),
            ((F.lit(len(missing)) == 0) & (F.col("rows") > 0) & one_rule & (F.col("scoped_rows") > 0)).alias("ok")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


POINTER = "CURRENT"


def publish_exports(frames: dict[str, DataFrame], target: str, min_fiscal_year: int) -> DataFrame:
    """Write every export to a new version folder, check the files, then move one pointer.

    Readers go through ``read_exports``, so they see the old set or the new
    one and nothing between.  A failing contract or a failed move leaves the
    pointer where it was.
    """
    spark = next(iter(frames.values())).sparkSession
    missing = {n: sorted(set(c) - set(frames[n].columns)) if n in frames else ["(export)"] for n, c in EXPORT_COLUMNS.items()}
    if any(missing.values()):
        raise ValueError(f"export contract failed, nothing published; missing: { {n: m for n, m in missing.items() if m} }")
    base, version = target.rstrip("/"), f"v-{uuid.uuid4().hex}"
    for name in EXPORT_COLUMNS:  # in the order of the contract
        frames[name].write.parquet(f"{base}/{version}/{name}")
    report = contract_report({n: spark.read.parquet(f"{base}/{version}/{n}") for n in EXPORT_COLUMNS}, min_fiscal_year)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    if report.where(~F.col("ok")).limit(1).count():
        refused = path(f"{base}/{version}")
        refused.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(refused, True)
        raise ValueError("export contract failed; nothing published")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path(base).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    fs = path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    new = path(f"{base}/{POINTER}-{version}")
    out = fs.create(new, True)
    out.write(bytearray(version.encode()))
    out.close()
    option = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    option[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(new, path(f"{base}/{POINTER}"), option)  # raises if it cannot
    return report


def read_exports(spark, target: str) -> dict[str, DataFrame]:
    """The published set of exports; an empty dict if nothing was published yet."""
    base = target.rstrip("/")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/{POINTER}")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return {}
    version = spark.read.text(f"{base}/{POINTER}").first()["value"]
    return {name: spark.read.parquet(f"{base}/{version}/{name}") for name in EXPORT_COLUMNS}


def write_csv(facts: DataFrame, path: str) -> None:
    """Processed facts as CSV with the fixed column order, sorted within files."""
    (facts.select(*FACT_CSV_COLUMNS)
     .sortWithinPartitions("fiscal_year", "fiscal_period", "metric")
     .write.mode("overwrite").option("header", True).csv(path))


def read_text_csv(spark, path: str, columns: list[str]) -> DataFrame:
    """A2: all-text CSV scan with header and an explicit all-STRING schema (no inference)."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.schema(schema).option("header", True).csv(path)


def scan_export(spark, path: str, columns: list[str], whole_numbers: list[str]) -> tuple[DataFrame | None, DataFrame]:
    """A3: one contracted CSV scan: the rows (NULL if there are none to use) and its one-row report.

    The file must be there, carry the required columns and hold rows; a row
    whose ``whole_numbers`` columns are no integers counts as bad.  Columns:
    status (ok, missing_file, missing_columns, empty, bad_rows),
    missing_columns, rows, bad_rows.
    """
    shape = "status string, missing_columns string, rows bigint, bad_rows bigint"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return None, spark.createDataFrame([("missing_file", "", 0, 0)], shape)
    header = spark.read.option("header", True).csv(path).columns
    missing = ", ".join(sorted(set(columns) - set(header)))
    rows = read_text_csv(spark, path, header)
    present = [c for c in whole_numbers if c in header]
    bad = F.lit(False)
    for c in present:
        bad = bad | F.coalesce(F.trim(c), F.lit("")).try_cast("bigint").isNull()
    counted = rows.agg(F.count("*").alias("rows"), F.count_if(bad).alias("bad_rows"))
    status = (F.when(F.lit(missing) != "", "missing_columns").when(F.col("rows") == 0, "empty")
              .when(F.col("bad_rows") > 0, "bad_rows").otherwise("ok"))
    report = counted.select(status.alias("status"), F.lit(missing).alias("missing_columns"), "rows", "bad_rows")
    return rows, report
