"""Late-arriving filings as a stream: newest filing wins, continuously.

The batch rule "latest filed observation per key" (and the Q4 derivation
that depends on it) is kept current as filing documents arrive:

    readStream.text(documents) -> foreachBatch(upsert)

``upsert`` for micro-batch ``b``:

1. explodes the new documents to observations and writes them to the
   observation store, partitioned by ``(entity_bucket, batch_id)`` with
   dynamic partition overwrite -- a replayed batch rewrites the same
   partitions, so retries after executor or driver loss are idempotent;
2. finds the entity buckets the batch touched and recomputes the facts of
   those buckets only, from the store (partition-pruned read), with the
   same operators as the batch job (one shuffle, map-side combine);
3. replaces exactly those facts partitions (dynamic overwrite), and removes
   the partition of a touched bucket that has no facts any more.

The number of buckets is the caller's choice and fixed for a store: a bucket
is what a batch reads and rewrites, so take the store's size over a few
hundred MB, and at least the executors' cores.

The array position used for "first seen wins" is made global as
``batch_id * 1e9 + position``, so an earlier batch beats a later one on ties.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterline.operators.observations import facts_from_observations
from quarterline.sources.facts_json import explode_documents



def entity_bucket(buckets: int, entity: str = "entity_id"):
    return F.pmod(F.xxhash64(F.col(entity)), F.lit(buckets)).cast("int")


def _dynamic_overwrite(df: DataFrame, path: str, *partition_cols: str) -> None:
    spark = df.sparkSession
    previous = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        df.write.mode("overwrite").partitionBy(*partition_cols).parquet(path)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", previous)


def make_upsert(store_path: str, facts_path: str, buckets: int):
    def upsert(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        obs = explode_documents(batch.select(F.col("value").alias("json")))
        obs = obs.select("*", (F.lit(batch_id).cast("bigint") * 1_000_000_000 + F.col("pos")).alias("gpos"),
                         entity_bucket(buckets).alias("entity_bucket"),
                         F.lit(batch_id).cast("bigint").alias("batch_id"))
        _dynamic_overwrite(obs, store_path, "entity_bucket", "batch_id")
        touched = [r[0] for r in spark.read.parquet(store_path).where(F.col("batch_id") == batch_id)
                   .select("entity_bucket").distinct().collect()]  # at most ``buckets`` numbers
        all_obs = spark.read.parquet(store_path).where(F.col("entity_bucket").isin(touched))
        facts = facts_from_observations(all_obs, position="gpos")
        _dynamic_overwrite(facts.withColumn("entity_bucket", entity_bucket(buckets)), facts_path,
                           "entity_bucket")
        left = {r[0] for r in facts.select(entity_bucket(buckets)).distinct().collect()}
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for bucket in set(touched) - left:
            gone = hadoop(f"{facts_path.rstrip('/')}/entity_bucket={bucket}")
            gone.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(gone, True)

    return upsert


def start(spark: SparkSession, documents_dir: str, store_path: str, facts_path: str, checkpoint: str,
          buckets: int, available_now: bool = True, max_files_per_trigger: int | None = None):
    """Start the stream (JSON-lines documents under ``documents_dir``) and return the query."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    docs = reader.load(documents_dir)
    writer = docs.writeStream.foreachBatch(make_upsert(store_path, facts_path, buckets)) \
        .option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
