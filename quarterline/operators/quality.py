"""Data-quality checks over the long fact table, per entity, as DataFrames.

Each check returns the offending keys; ``summary`` folds them into one
pass/fail row per entity.  Inputs may be raw text (as read from CSV) or
typed; values are coerced with ``try_cast`` so bad text never raises.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterline.functions.metrics import CORE_METRICS
from quarterline.functions.periods import QUARTERS

ENTITY = "entity_id"
KEY = [ENTITY, "metric", "fiscal_year", "fiscal_period"]
# Fixed value: columns that may not be NULL in the loaded table.
NOT_NULL = ["metric", "sec_metric", "start_date", "end_date", "fiscal_year", "fiscal_period", "value", "form"]


def as_int(c: Column | str) -> Column:
    """Python ``int(text)`` on text: surrounding blanks allowed, no fractions."""
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("string").try_cast("bigint")


def coerce_numeric(df: DataFrame, excluded: set[str], numeric: str = "decimal(38,6)") -> DataFrame:
    """A4: every column not in ``excluded`` through ``try_cast`` in one select."""
    return df.select(*[
        F.col(c) if c in excluded else F.col(c).cast("string").try_cast(numeric).alias(c) for c in df.columns
    ])


def metric_domain(facts: DataFrame) -> DataFrame:
    """(entity_id, metric, issue) for missing and unexpected metrics."""
    found = facts.select(ENTITY, "metric").distinct()
    expected = facts.select(ENTITY).distinct().select(
        ENTITY, F.explode(F.array(*[F.lit(m) for m in CORE_METRICS])).alias("metric"))
    missing = expected.join(found, [ENTITY, "metric"], "left_anti").withColumn("issue", F.lit("missing"))
    unexpected = found.where(~F.col("metric").isin(*CORE_METRICS)).withColumn("issue", F.lit("unexpected"))
    return missing.unionByName(unexpected)


def duplicate_keys(facts: DataFrame) -> DataFrame:
    """Keys that occur more than once."""
    return facts.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def missing_periods(facts: DataFrame, min_fiscal_year: int) -> DataFrame:
    """For each observed (entity, metric, year >= floor), expected quarters not found.

    Only observed (metric, year) pairs are checked: a metric absent for a
    whole year is reported by the metric check, not here.
    """
    year = as_int("fiscal_year")
    seen = (facts.where(year >= min_fiscal_year)
            .groupBy(ENTITY, "metric", "fiscal_year")
            .agg(F.collect_set("fiscal_period").alias("found")))
    return seen.select(
        ENTITY, "metric", "fiscal_year",
        F.explode(F.array_except(F.array(*[F.lit(q) for q in QUARTERS]), F.col("found"))).alias("fiscal_period"))


def invalid_values(facts: DataFrame) -> DataFrame:
    """Values that are not integers, or exactly zero (negatives are valid)."""
    v = as_int("value")
    return facts.where(v.isNull() | (v == 0)).select(*KEY, F.col("value").cast("string").alias("value"))


def summary(facts: DataFrame, min_fiscal_year: int) -> DataFrame:
    """Per entity row count, year range and the AND of the four checks.

    One pass over the facts: a per-key aggregate (rows, bad values), rolled up
    per (entity, metric, year) (quarters found) and per entity -- every check
    is a flag carried through the chain, so the raw table is read once and no
    check result is joined back.
    """
    year = as_int("fiscal_year")
    v = as_int("value")
    per_key = facts.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(v.isNull() | (v == 0), 1).otherwise(0)).alias("bad_values"),
        F.min(year).alias("y"),
    )
    per_year = per_key.groupBy(ENTITY, "metric", "fiscal_year").agg(
        F.sum("n").alias("n"),
        F.sum("bad_values").alias("bad_values"),
        F.max((F.col("n") > 1).cast("int")).alias("dup"),
        F.min("y").alias("y"),
        F.count_distinct(F.when(F.col("fiscal_period").isin(*QUARTERS), F.col("fiscal_period"))).alias("quarters"),
    )
    gap = (F.col("y") >= min_fiscal_year) & (F.col("quarters") < len(QUARTERS))
    out = per_year.groupBy(ENTITY).agg(
        F.sum("n").cast("bigint").alias("rows"),
        F.min("y").cast("int").alias("min_fiscal_year"),
        F.max("y").cast("int").alias("max_fiscal_year"),
        ((F.count_distinct(F.when(F.col("metric").isin(*CORE_METRICS), F.col("metric"))) == len(CORE_METRICS))
         & ~F.bool_or(~F.col("metric").isin(*CORE_METRICS))).alias("metrics_ok"),
        (F.max("dup") == 0).alias("duplicates_ok"),
        (~F.coalesce(F.bool_or(F.coalesce(gap, F.lit(False))), F.lit(False))).alias("periods_ok"),
        (F.sum("bad_values") == 0).alias("values_ok"),
    )
    passed = F.col("metrics_ok") & F.col("duplicates_ok") & F.col("periods_ok") & F.col("values_ok")
    return out.withColumn("passed", passed)


def load_constraints(facts: DataFrame) -> DataFrame:
    """Per entity, NOT NULL violations and duplicate keys; loadable iff both 0."""
    null_any = F.lit(False)
    for c in NOT_NULL:
        null_any = null_any | F.col(c).isNull()
    per_key = facts.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(null_any, 1).otherwise(0)).alias("nulls"),
    )
    return per_key.groupBy(ENTITY).agg(
        F.sum("n").cast("bigint").alias("rows"),
        F.sum("nulls").cast("bigint").alias("not_null_violations"),
        F.sum(F.when(F.col("n") > 1, 1).otherwise(0)).cast("bigint").alias("duplicate_keys"),
    ).withColumn("loadable", (F.col("not_null_violations") == 0) & (F.col("duplicate_keys") == 0))


def load_table(facts: DataFrame, path: str) -> DataFrame:
    """A6 sink: full refresh, refused unless every entity passes.

    The facts are written once beside the target, the written files are
    checked, and only then take the target's place; a failure at any step
    leaves the previous load in use.  Parquet, partitioned by fiscal year.
    """
    spark = facts.sparkSession
    base, tag = path.rstrip("/"), uuid.uuid4().hex
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    target, staged, old = hadoop(base), hadoop(f"{base}.staged-{tag}"), hadoop(f"{base}.old-{tag}")
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    facts.write.partitionBy("fiscal_year").parquet(staged.toString())
    report = load_constraints(spark.read.schema(facts.schema).parquet(staged.toString()))
    if report.where(~F.col("loadable")).limit(1).count():
        fs.delete(staged, True)
        raise ValueError("load refused: NOT NULL or UNIQUE constraint violated")
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        raise OSError(f"cannot set the previous load of {base} aside")
    if not fs.rename(staged, target):
        if had:
            fs.rename(old, target)
        raise OSError(f"cannot move the new load to {base}")
    if had:
        fs.delete(old, True)
    return load_constraints(spark.read.schema(facts.schema).parquet(base))


def save_bucketed(facts: DataFrame, table: str, buckets: int) -> DataFrame:
    """A6 (table form): constraint-gated full refresh into a catalog table bucketed
    and sorted by ``entity_id``.

    Readers that group or window by entity (the pivot, every analytics
    window) then run without a shuffle: the buckets already co-locate each
    entity.  The bucket count is fixed per table; size it so one bucket file
    stays around a few hundred MB at the target scale.
    """
    spark, staged = facts.sparkSession, f"{table}_staged_{uuid.uuid4().hex}"
    (facts.write.format("parquet").bucketBy(buckets, ENTITY).sortBy(ENTITY, "fiscal_year").saveAsTable(staged))
    # what was written is what is checked
    if load_constraints(spark.table(staged)).where(~F.col("loadable")).limit(1).count():
        spark.sql(f"DROP TABLE {staged}")
        raise ValueError("load refused: NOT NULL or UNIQUE constraint violated")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
    return spark.table(table)
