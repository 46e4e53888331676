"""Layout of an input before the CPU-heavy tokenizer."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Below this a task is not worth its start.
_MIN_TASK_BYTES = 256 * 1024


def spread(df: DataFrame) -> DataFrame:
    """Spread a small input over all cores.

    A file cannot be split below a row group, so a small table may arrive as one
    partition. Inputs with enough bytes to fill every core with full-sized splits
    are left as they are. Below that the exchange of the raw text costs a few per
    cent of the tokenizing it spreads. The estimate decides the layout only, never
    the result.
    """
    if df.isStreaming:
        return df
    session = df.sparkSession._jsparkSession
    cores = df.sparkSession.sparkContext.defaultParallelism
    split = session.sessionState().conf().filesMaxPartitionBytes()
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    size = int(str(stats.sizeInBytes()))
    parts = min(cores, size // _MIN_TASK_BYTES + 1)
    if size >= cores * split or parts == 1:
        return df
    # Only now is the input planned. Partitions are never made fewer, and where there
    # are enough they stay as they are.
    return df if _partitions(df) >= parts else df.repartition(parts)


def _partitions(df: DataFrame) -> int:
    """As planned; a scan is asked directly, which runs nothing."""
    plan = df._jdf.queryExecution().sparkPlan()
    if "Exchange" in plan.toString() or "Join" in plan.toString():
        return plan.outputPartitioning().numPartitions()
    return df.rdd.getNumPartitions()
