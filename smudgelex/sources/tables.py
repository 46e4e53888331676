"""Word lists and reference tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """``(token)``, one row per line. Blank and repeated lines are kept."""
    return spark.read.text(path).select(F.col("value").alias("token"))


def read_reference(
    spark: SparkSession,
    column: str,
    path: str | None = None,
    jdbc: dict[str, str] | None = None,
) -> DataFrame:
    """The key column of a reference table, from parquet files or a database.

    ``jdbc`` takes the options of Spark's JDBC source (url, dbtable, user, …; add
    partitionColumn and bounds to read a large table in parallel).
    """
    if (path is None) == (jdbc is None):
        raise ValueError("give either path or jdbc")
    if path is not None:
        table = spark.read.parquet(path)
    else:
        table = spark.read.format("jdbc").options(**jdbc).load()
    return table.select(column)
