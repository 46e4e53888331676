"""Where intermediate tables live, and when a side is small enough to broadcast."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Broadcast sides are measured and stay below this; larger ones are joined by shuffle.
BROADCAST_BYTES = 256 * 1024 * 1024
# Cost of one row in a broadcast hash table, on top of its text, as Spark reports it.
_ROW_OVERHEAD = 124


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without the setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not named:
        named = context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="smudgelex-")
        context.setCheckpointDir(named)
    return named


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialized(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and safe
    from the loss of any executor.

    Tasks move their own files into place, not the driver one by one: the path is new and
    is read only once the whole job has ended, so a job that fails leaves nothing to read.
    """
    path = fresh_path(df.sparkSession, "table")
    df.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits_broadcast(df: DataFrame, column: str, limit: int = BROADCAST_BYTES) -> bool:
    """Measure a finished table: one aggregate, one row back to the driver."""
    cost = F.sum(F.octet_length(column) + F.lit(_ROW_OVERHEAD))
    size = df.agg(F.coalesce(cost, F.lit(0)).alias("size")).first()["size"]
    return size <= limit
