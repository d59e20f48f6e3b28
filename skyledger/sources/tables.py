"""Reading, binding, profiling, exporting."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Collection, Iterable, Iterator, Mapping
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import storage
from .schemas import RAW_TABLES, read_schema
from .versions import KEEP_HOURS, clustered, drop_superseded, publish, write_version

# The tables an export consists of, in order.
EXPORTED_TABLES = (
    "dim_customers",
    "dim_routes",
    "dim_airports",
    "dim_fare_families",
    "fact_bookings",
    "fact_flights",
    "mart_customer_segments",
    "mart_route_performance",
    "int_customer_metrics",
    "int_route_metrics",
)


def read_raw(
    spark: SparkSession,
    folder: str,
    table: str,
    infer: bool = False,
    multi_line: bool = False,
    as_text: Collection[str] = (),
) -> DataFrame | None:
    """The feed ``<folder>/<table>.parquet`` or else ``<table>.csv`` (a file or a folder of files); None if there is neither.

    Types of a CSV feed are declared per column name, so the file is read once and its column order does not matter; a
    value that does not fit its type stops the job, except in columns read ``as_text``. ``infer`` lets Spark look at the
    data instead, at the price of a second read. Quoted line breaks need ``multi_line``: one pass then finds the files that
    have any, and each of these is read whole by one task, all others in parts as usual. Feeds with line breaks are better
    passed on as Parquet.
    """
    try:
        return spark.read.parquet(posixpath.join(folder, f"{table}.parquet"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    path = posixpath.join(folder, f"{table}.csv")
    reader = spark.read.option("header", True).option("escape", '"')
    try:
        header = reader.option("multiLine", multi_line).csv(path).columns
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    if infer:
        return reader.option("multiLine", multi_line).option("inferSchema", True).option("preferDate", True).csv(path)
    schema = read_schema(table, header, as_text)
    reader = reader.option("mode", "FAILFAST").option("enforceSchema", False).schema(schema)
    parted, whole = _by_line_breaks(spark, path) if multi_line else ([path], [])
    parts = [reader.option("multiLine", broken).csv(files) for files, broken in ((parted, False), (whole, True)) if files]
    return reduce(DataFrame.unionAll, parts)


def _by_line_breaks(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """The files of a CSV feed without and with line breaks inside quotes.

    Quotes inside quoted text are doubled, so a line of an odd number of quotes begins or ends a text that goes on. Only the
    names of files come to the driver.
    """
    lines = spark.read.text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    odd = lines.withColumn("file", F.input_file_name()).filter(quotes % 2 == 1).select("file").distinct()
    # both name files as URLs
    whole = {unquote(r["file"]) for r in odd.collect()}
    every = sorted(map(unquote, lines.inputFiles()))
    return [f for f in every if f not in whole], [f for f in every if f in whole]


def quoted(*names: str) -> str:
    """Names as one SQL identifier, whatever characters they hold."""
    return ".".join("`" + n.replace("`", "``") + "`" for n in names)


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    path = (location or "").replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}" + (f" LOCATION '{path}'" if location else ""))


def write_parquet(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Write a frame aside and put it in place when it is whole; returns it as stored.

    For files that others read by their path. On an object store the move copies; tables are stored by ``replace_table``.
    """
    spark, fresh = df.sparkSession, f"{path}.new-{uuid.uuid4().hex}"
    writer = clustered(df, partition_by).write
    try:
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(fresh)
    except BaseException:
        storage.delete(spark, fresh)
        raise
    storage.swap_in(spark, fresh, path)
    return spark.read.parquet(path)


def _bind(spark: SparkSession, database: str, table: str, folder: str) -> None:
    """Make a folder's files readable as ``database.table``, in one step of the catalog."""
    name = quoted(database, table)
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")  # stored before tables had versions
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.{quoted(folder)}")


def replace_table(
    df: DataFrame,
    database: str,
    table: str,
    location: str | None = None,
    partition_by: str | None = None,
    keep_hours: float = KEEP_HOURS,
) -> DataFrame:
    """Replace ``database.table`` by the frame and return the stored table; a failed write leaves the old one.

    The table is the folder of its name in ``location`` (that of the database if none is given), with a version for each
    write. Readers of the path find the version through its marker, readers of the name through a view on its folder; both
    are switched in one step each, when the version is whole, and meet the former version until then.
    """
    spark = df.sparkSession
    path = posixpath.join(location or spark.catalog.getDatabase(quoted(database)).locationUri, table)
    folder = write_version(df, path, partition_by)
    publish(spark, path, folder)
    _bind(spark, database, table, folder)
    drop_superseded(spark, path, keep_hours)
    return spark.read.parquet(folder)


def ingest_raw(
    spark: SparkSession,
    folder: str,
    database: str = "raw",
    location: str | None = None,
    tables: Iterable[str] = RAW_TABLES,
    **read_options,
) -> tuple[dict[str, DataFrame], list[str]]:
    """Store every feed found in the folder as a table; returns the stored tables and the names not found."""
    ensure_database(spark, database, location)
    found = {name: read_raw(spark, folder, name, **read_options) for name in tables}
    stored = {n: replace_table(df, database, n, location) for n, df in found.items() if df is not None}
    return stored, [n for n in found if n not in stored]


def bind_views(tables: Mapping[str, DataFrame]) -> None:
    """Make the frames usable by name in SQL; nothing is computed."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def table_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row and column count; over Parquet the counts come from the file footers."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count")
        )
        for name, df in tables.items()
    ]
    if not counts:
        none = "table_name string, row_count long, column_count int"
        return SparkSession.active().createDataFrame([], none)
    return reduce(DataFrame.unionAll, counts)


def export_tables(
    tables: Mapping[str, DataFrame],
    folder: str,
    names: Iterable[str] = EXPORTED_TABLES,
    partition_by: Mapping[str, str] | None = None,
) -> tuple[DataFrame, list[str]]:
    """Write the named tables to Parquet folders below ``folder``.

    Returns the counts of what was written, read back from the file footers, and the names that do not exist.
    """
    layout = partition_by or {}
    written = {}
    for name in names:
        if name in tables:
            written[name] = write_parquet(tables[name], posixpath.join(folder, f"{name}.parquet"), layout.get(name))
    counts = table_profile(written).select("table_name", "row_count")
    return counts, [n for n in names if n not in written]


def write_csv(df: DataFrame, path: str) -> None:
    """Write a frame as CSV with a header, quotes doubled inside quoted text, blanks and line breaks kept."""
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def records(df: DataFrame) -> Iterator[dict]:
    """The rows as dicts, fetched partition by partition, so a result of any size passes through little memory."""
    return (r.asDict(recursive=True) for r in df.toLocalIterator())
