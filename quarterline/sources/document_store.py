"""Approved documents in entity buckets behind a versioned manifest.

The store keeps one row per (entity, period).  Rows lie in a fixed number of
entity buckets, never in a folder per entity.  Publishing writes the touched
buckets to a new version folder and then commits a manifest that names, per
bucket, the folder in force.  Manifests are numbered; a commit renames its
file to the next number and fails if that number is taken, so of two
concurrent writers the later one merges again on top of the other.  Readers
take the highest manifest and never see half a change.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = ["entity_id", "fiscal_year", "fiscal_period"]
SCHEMA = ("entity_id long, fiscal_year int, fiscal_period string, document string, document_digest string, "
          "knowledge_digest string")
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
BUCKETS = 64
_MANIFEST = "manifest-"


class _Files:
    """The few file-system calls the store needs, on whatever system the path names."""

    def __init__(self, spark: SparkSession, base: str):
        self.jvm, self.base = spark.sparkContext._jvm, base.rstrip("/")
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path("").getFileSystem(self.conf)
        self.gateway = spark.sparkContext._gateway

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}" if name else self.base)

    def names(self) -> list[str]:
        if not self.fs.exists(self.path("")):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path("")))

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        out = self.fs.create(self.path(name), True)
        out.write(bytearray(text.encode()))
        out.close()

    def commit(self, source: str, target: str) -> bool:
        """Renames unless the target is there already."""
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path("").toUri(), self.conf)
        none = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self.path(source), self.path(target), none)
        except Exception as error:  # py4j wraps the Java exception
            if "FileAlreadyExistsException" in str(error):
                return False
            raise
        return True

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def _manifest(files: _Files) -> tuple[int, dict]:
    """The highest manifest's number and content; number 0 before the first."""
    names = [n for n in files.names() if n.startswith(_MANIFEST) and n.endswith(".json")]
    if not names:
        return 0, {"buckets": BUCKETS, "folders": {}}
    return int(names[-1][len(_MANIFEST):-len(".json")]), json.loads(files.read(names[-1]))


def _rows(spark: SparkSession, base: str, folders: dict[str, str]) -> DataFrame:
    paths = [f"{base.rstrip('/')}/{folder}/bucket={bucket}" for bucket, folder in sorted(folders.items())]
    if not paths:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(*paths)


def read(spark: SparkSession, base: str) -> DataFrame:
    """All documents in force; empty before the first publish."""
    return _rows(spark, base, _manifest(_Files(spark, base))[1]["folders"])


def publish(documents: DataFrame, base: str, buckets: int = BUCKETS, attempts: int = 10, before_commit=None) -> int:
    """Replaces the documents' (entity, period) rows, all or none; returns the manifest's number.

    ``documents``: the columns of ``SCHEMA``, one row per key.  Rows of other
    keys stay.  ``buckets`` counts for a new store only.  ``before_commit`` is
    called before every commit (tests).
    """
    spark, files = documents.sparkSession, _Files(documents.sparkSession, base)
    for _ in range(attempts):
        number, manifest = _manifest(files)
        count = manifest["buckets"] if number else buckets
        placed = documents.select(*COLUMNS, F.pmod(F.xxhash64("entity_id"), F.lit(count)).cast("int").alias("bucket"))
        touched = sorted(r["bucket"] for r in placed.select("bucket").distinct().collect())  # at most ``buckets`` numbers
        if not touched:
            return number
        old = _rows(spark, base, {str(b): f for b, f in manifest["folders"].items() if int(b) in touched})
        kept = old.join(placed.select(*KEY), KEY, "left_anti").withColumn(
            "bucket", F.pmod(F.xxhash64("entity_id"), F.lit(count)).cast("int"))
        folder = f"v-{uuid.uuid4().hex}"
        kept.select(*COLUMNS, "bucket").unionByName(placed).repartition("bucket").write.partitionBy("bucket").parquet(
            f"{files.base}/{folder}")
        folders = {**manifest["folders"], **{str(b): folder for b in touched}}
        draft = f"draft-{folder}.json"
        files.write(draft, json.dumps({"buckets": count, "folders": folders}, sort_keys=True))
        if before_commit is not None:
            before_commit()
        if files.commit(draft, f"{_MANIFEST}{number + 1:012d}.json"):
            return number + 1
        files.delete(draft)  # another writer was first: merge again on top of its rows
        files.delete(folder)
    raise RuntimeError(f"no commit in {attempts} attempts")


def vacuum(spark: SparkSession, base: str, keep: int = 2) -> None:
    """Deletes all manifests but the last ``keep`` and every folder that none of those names."""
    files = _Files(spark, base)
    names = files.names()
    manifests = [n for n in names if n.startswith(_MANIFEST)]
    live = {f for n in manifests[-keep:] for f in json.loads(files.read(n))["folders"].values()}
    for name in manifests[:-keep]:
        files.delete(name)
    for name in names:
        if name.startswith("v-") and name not in live:
            files.delete(name)
