"""Reference keys as bucketed tables, for tables too large to broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Buckets of a table whose size nobody named; a bucket should fit a task's memory.
BUCKETS = 64


def store_keys(keys: DataFrame, name: str, buckets: int = BUCKETS) -> DataFrame:
    """Write ``(key, kind)`` rows to the catalog, dealt out and sorted by key.

    A join with the stored table moves the other side only: each bucket meets the words
    that belong to it, however often the table is used.
    """
    writer = keys.write.mode("overwrite").format("parquet")
    writer.bucketBy(buckets, "key").sortBy("key").saveAsTable(name)
    return stored_keys(keys.sparkSession, name)


def stored_keys(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
