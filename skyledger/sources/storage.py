"""Where jobs put data that other tasks must be able to read."""

from __future__ import annotations

import posixpath
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

SHARED_FOLDER = "spark.checkpoint.dir"


@cache
def _local_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="skyledger-")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; in local mode a temporary one when the setting is absent."""
    named = spark.conf.get(SHARED_FOLDER, None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SHARED_FOLDER} to a folder all executors can reach")
    return _local_folder(spark.sparkContext.applicationId)


def _file_system(spark: SparkSession, path: str):
    """The file system a path is on, and the path in its terms."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared folder, deleted with the session if nobody deletes it before."""
    path = posixpath.join(shared_folder(spark), f"{purpose}-{uuid.uuid4().hex}")
    files, place = _file_system(spark, path)
    files.mkdirs(place)
    files.deleteOnExit(place)
    return path


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds; nothing happens if it does not exist."""
    files, place = _file_system(spark, path)
    files.delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _file_system(spark, path)
    return files.exists(place)


def make_folder(spark: SparkSession, path: str) -> None:
    files, place = _file_system(spark, path)
    files.mkdirs(place)


def make_file(spark: SparkSession, path: str) -> None:
    """Make an empty file that does not exist yet."""
    files, place = _file_system(spark, path)
    files.create(place, False).close()


def listed(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """The names in a folder, with the time (seconds since 1970) each was last changed; none if there is no such folder."""
    files, place = _file_system(spark, path)
    if not files.exists(place):
        return []
    return [(s.getPath().getName(), s.getModificationTime() / 1000) for s in files.listStatus(place)]


def swap_in(spark: SparkSession, fresh: str, path: str) -> None:
    """Put a finished folder in the place of ``path``; what was there goes only when the new one stands."""
    files, place = _file_system(spark, path)
    old = _file_system(spark, f"{path}.old-{uuid.uuid4().hex}")[1]
    had = files.exists(place)
    if had and not files.rename(place, old):
        raise OSError(f"cannot move {path} aside")
    if not files.rename(_file_system(spark, fresh)[1], place):
        if had:
            files.rename(old, place)
        raise OSError(f"cannot move {fresh} to {path}")
    if had:
        files.delete(old, True)
