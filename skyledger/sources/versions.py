"""Stored tables that are replaced in one step.

A table is a folder with a folder for each version and, below ``_current``, an empty marker for each finished one, named by
its number and its folder. The marker with the highest number names the table. Making an empty file is one step on any
file system, so a reader finds the former version or the new one, and a writer that is killed leaves the former. Nothing is
moved or overwritten. A version is deleted when it has been superseded for some hours, so that readers can finish.

One writer at a time is meant for each table; of two at once the one with the later marker counts.
"""

from __future__ import annotations

import posixpath
import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import storage

MARKERS = "_current"
#: Hours that a superseded version is kept for its readers, and what a killed writer left for the next.
KEEP_HOURS = 24.0


def clustered(df: DataFrame, column: str | None) -> DataFrame:
    """The frame with rows of a column's value together, so a folder gets few files; Spark splits large values."""
    return df.hint("rebalance", F.col(column)) if column else df


def _markers(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """The markers of a table in the order of their numbers, with the time each was made."""
    return sorted(storage.listed(spark, posixpath.join(path, MARKERS)))


def _folder(path: str, marker: str) -> str:
    return posixpath.join(path, marker.partition(".")[2])


def current(spark: SparkSession, path: str) -> str | None:
    """The folder of a table's current version; None if no version was ever finished."""
    known = _markers(spark, path)
    return _folder(path, known[-1][0]) if known else None


def write_version(df: DataFrame, path: str, partition_by: str | None = None) -> str:
    """Write a frame as a version that nobody reads yet; returns its folder."""
    spark, folder = df.sparkSession, posixpath.join(path, f"v{uuid.uuid4().hex}")
    storage.make_folder(spark, posixpath.join(path, MARKERS))
    writer = clustered(df, partition_by).write
    try:
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(folder)
    except BaseException:
        storage.delete(spark, folder)
        raise
    return folder


def publish(spark: SparkSession, path: str, folder: str) -> None:
    """Make a finished version the current one."""
    known = _markers(spark, path)
    number = int(known[-1][0].partition(".")[0]) + 1 if known else 0
    storage.make_file(spark, posixpath.join(path, MARKERS, f"{number:012d}.{posixpath.basename(folder)}"))


def drop_superseded(spark: SparkSession, path: str, keep_hours: float = KEEP_HOURS) -> None:
    """Delete versions that were superseded so many hours ago, and folders as old that no marker names."""
    known, old = _markers(spark, path), time.time() - 3600 * keep_hours
    for (marker, _), (_, superseded) in zip(known, known[1:]):
        if superseded <= old:
            storage.delete(spark, posixpath.join(path, MARKERS, marker))
            storage.delete(spark, _folder(path, marker))
    named = {marker.partition(".")[2] for marker, _ in known}
    for name, made in storage.listed(spark, path):
        if name != MARKERS and name not in named and made <= old:
            storage.delete(spark, posixpath.join(path, name))


def read_stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at a path: its current version, or the Parquet files of a plain folder; None if there is neither."""
    folder = current(spark, path)
    if folder is None and storage.exists(spark, posixpath.join(path, MARKERS)):
        return None
    try:
        return spark.read.parquet(folder or path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
