"""The same jobs on files that keep arriving."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from smudgelex.operators.lexicon import build_lexicon


def write_token_stream(
    tokens: DataFrame, path: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Append a token stream to parquet files, each input file exactly once.

    With ``available_now`` the query reads what is there and ends; without, it runs
    on. A query that is started again with the same checkpoint goes on where it was.
    """
    writer = tokens.writeStream.format("parquet").option("path", path)
    writer = writer.option("checkpointLocation", checkpoint).outputMode("append")
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def write_counts(
    tokens: DataFrame, path: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Count a token stream, a folder of counts for each micro-batch.

    No state is kept: a batch is counted by itself and replaces what an earlier attempt
    at the same batch may have written. ``read_counts`` adds the batches up.
    """

    def count(batch: DataFrame, number: int) -> None:
        build_lexicon(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = tokens.writeStream.foreachBatch(count)
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """``(token, n)`` of all batches written so far."""
    parts = spark.read.schema("token string, n bigint, batch bigint").parquet(path)
    return parts.groupBy("token").agg(F.sum("n").alias("n"))


def compact_counts(spark: SparkSession, path: str, into: str) -> None:
    """The batches of a stream that is not running as one batch in another folder.

    Run the stream on with the same checkpoint and the new folder: batch numbers rise,
    so later batches stand beside the sum.
    """
    read_counts(spark, path).write.mode("overwrite").parquet(f"{into}/batch=-1")
