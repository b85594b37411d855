"""Session helpers for local runs, tests and the bench.

On a cluster the session is handed in by the caller; ``local_session`` serves
tests and the bench.  Intermediates that several consumers share are cached
by Spark (``reuse``): nothing runs before the first action, no folder is
named, and blocks lost with an executor are computed again.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
    "spark.sql.ansi.enabled": "true",
    # The JVM does not JIT-compile methods above 8000 bytes of bytecode; at this
    # limit Spark splits or falls back instead of running one interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cpus: int | str = "*", app: str = "quarterline", **conf: str) -> SparkSession:
    """A local session with the settings the tests and the bench rely on."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in {**LOCAL_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def reuse(df: DataFrame) -> DataFrame:
    """``df`` kept on the executors' disks from its first use on, so that several
    consumers share one evaluation and one plan.  Lazy; equal plans share one
    copy; ``spark.catalog.clearCache()`` frees it."""
    return df.persist(StorageLevel.DISK_ONLY)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    A session without the setting (tests) gets a folder of its own, which
    only a local master may use.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="quarterline-shared-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/fiscal/{name}-{uuid.uuid4().hex}"
