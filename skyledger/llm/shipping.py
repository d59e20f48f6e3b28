"""Giving executors the library where it is not installed."""

from __future__ import annotations

import os
import tempfile
import zipfile
from functools import cache
from pathlib import Path

from pyspark.sql import SparkSession

import skyledger


@cache
def _archive() -> str:
    """A zip of the library's modules."""
    top = Path(skyledger.__file__).parent
    path = os.path.join(tempfile.mkdtemp(prefix="skyledger-"), "skyledger.zip")
    with zipfile.ZipFile(path, "w") as out:
        for p in sorted(top.rglob("*.py")):
            out.write(p, p.relative_to(top.parent).as_posix())
    return path


@cache
def _added(application_id: str) -> set[str]:
    return set()


def ship(spark: SparkSession) -> None:
    """Send the library to the session's Python workers, once per application."""
    done = _added(spark.sparkContext.applicationId)
    if not done:
        spark.sparkContext.addPyFile(_archive())
        done.add(_archive())
