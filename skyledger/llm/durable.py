"""Cutting lineage in the folder that all executors share."""

from __future__ import annotations

import gc
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skyledger.sources.storage import shared_folder


def durable(df: DataFrame) -> DataFrame:
    """The rows of df, stored by a checkpoint in the shared folder, so that a lost executor costs no recomputation."""
    spark: SparkSession = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


#: Rows of a small stored frame that one task is meant to read, and tasks that read it at least.
TASK_ROWS, LEAST_TASKS = 4096, 6


def counted(df: DataFrame, *more: Column, store: Callable[[DataFrame], DataFrame] = durable) -> tuple[DataFrame, dict]:
    """The stored rows of df, with their number as ``rows`` and further aggregates, taken while they are stored.

    For narrow rows: a frame of few rows in many partitions is read by fewer tasks, in proportion to its rows.
    """
    seen = Observation()
    stored = store(df.observe(seen, F.count(F.lit(1)).alias("rows"), *more))
    found = seen.get
    return stored.coalesce(max(LEAST_TASKS, -(-found["rows"] // TASK_ROWS))), found


def release(spark: SparkSession) -> None:
    """Have Spark delete the shuffles and checkpoints that no frame refers to any more, which it does after the driver's garbage
    collections only. Called where a job has put away large stored frames."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
