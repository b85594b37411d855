"""Helpers shared by the corpus operators: table reading, shared intermediates, components.

Everything here is Spark work on distributed frames.  The only rows that reach
the driver are counts.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives this package to the Python workers of the session, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="quarterline-code-")) / f"{root.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    sc.addPyFile(str(target))
    _shipped.add(sc.applicationId)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session (tests) may lack it and then gets its own
    temporary folder; on a cluster a missing setting is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="quarterline-shared-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back (cuts the lineage)."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string")) % F.lit(n)


def word_count(text: Column) -> Column:
    """Number of words of a text as BIGINT; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """Connected components of undirected ``edges(a, b)`` as ``(node, component)``.

    ``component`` is the smallest node of the component.  Alternating star
    steps: every round points the neighbours of a node to the smallest one,
    written as an aggregate (combined before the shuffle) and an equi-join,
    so no neighbour list is ever gathered.  Nodes without an edge are absent.
    Each round is checkpointed to the shared folder.
    """
    spark = edges.sparkSession
    shared_dir(spark)
    a, b = F.col("a"), F.col("b")

    def stars(e: DataFrame, small: bool) -> DataFrame:
        if small:  # each node with its smaller neighbours
            near = e.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        else:
            near = e.select(a.alias("u"), b.alias("v")).union(e.select(b.alias("u"), a.alias("v")))
        low = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        near = near.join(low, "u")
        if not small:
            near = near.filter(F.col("v") > F.col("u"))
        out = near.select(F.col("v").alias("a"), F.col("m").alias("b"))
        if small:
            out = out.union(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return out.filter(a != b).distinct()

    current = edges.select("a", "b").filter(a != b).distinct().checkpoint()
    seen = None
    for _ in range(max_rounds):
        current = stars(stars(current, small=False), small=True).checkpoint()
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    else:
        raise RuntimeError("components did not settle")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
