"""What Python workers need before they run code of this package."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package as the driver does.

    On a cluster it is installed or sent with ``--py-files``; then this changes nothing.
    """
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
