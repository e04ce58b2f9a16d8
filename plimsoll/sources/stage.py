"""Write-once staging of narrow intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names for checkpoints.

    Where none is named, a session whose driver and tasks are one process gets a folder of its own;
    on a cluster that is an error, since executors would write to their own disks.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that the driver and all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL:
        _LOCAL[application] = tempfile.mkdtemp(prefix="plimsoll-")
    return _LOCAL[application]


def staged(df: DataFrame) -> DataFrame:
    """Store a table that several parts of a report read, and read it back.

    Meant for the narrow columns taken from a text scan: they are a small fraction of the text,
    so writing them costs far less than scanning again, and a lost executor later on re-reads
    files instead of re-running the scan. Columnar, so each reader takes only what it needs.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/plimsoll/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
