"""What tables hold, in a form that Spark and DuckDB compute alike: checksums of every column and of whole rows."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A double is told exactly, in whole units and two times 52 bits, since engines write doubles differently. What is finer
#: than 2^-104 is not told, and one of 2^62 or more stops the check.
BITS = float(1 << 52)


def _as_text(name: str, kind: T.DataType) -> Column:
    """A value as text, the same in both engines."""
    c = F.col(f"`{name}`")
    if kind != T.DoubleType():
        return c.cast("string")
    units = F.floor(c)
    fine = (c - units) * BITS
    finest = (fine - F.floor(fine)) * BITS
    return F.concat_ws("/", *[x.cast("bigint").cast("string") for x in (units, F.floor(fine), F.floor(finest))])


def _total(text: Column) -> Column:
    """The sum of the digests (48 bits) of a column's values as text, added up as longs in two halves, which is exact below 2^39 rows."""
    digest = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")
    high, low = (F.sum(half).cast("decimal(20,0)") for half in (F.shiftright(digest, 24), digest.bitwiseAND(F.lit((1 << 24) - 1))))
    return (high * F.lit(1 << 24).cast("decimal(8,0)") + low).cast("string")


def contents(tables: Mapping[str, DataFrame]) -> DataFrame:
    """For each column of each table the number of rows and values and the sum of the values' digests, and for the table the
    sum of the digests of whole rows, which changes if a value moves to another row."""

    def of(name: str, df: DataFrame) -> DataFrame:
        texts = {f.name: F.when(F.col(f"`{f.name}`").isNotNull(), _as_text(f.name, f.dataType)) for f in df.schema.fields}
        cells = df.select(*[c.alias(n) for n, c in texts.items()])
        row = F.concat_ws("|", *[F.concat(F.lit(f"{n}="), F.coalesce(F.col(f"`{n}`"), F.lit("null"))) for n in sorted(texts)])
        each = [
            F.struct(F.lit(n).alias("column_name"), F.count(f"`{n}`").alias("value_count"), _total(F.col(f"`{n}`")).alias("checksum"))
            for n in texts
        ]
        found = cells.agg(F.count(F.lit(1)).alias("row_count"), _total(row).alias("row_checksum"), F.array(*each).alias("each"))
        return found.select(F.lit(name).alias("table_name"), "row_count", F.inline("each"), "row_checksum")

    return reduce(DataFrame.unionAll, [of(n, df) for n, df in tables.items()])


def contents_sql(table: str) -> str:
    """The same for one table, for DuckDB; ``{table}`` is left to be filled in."""
    value = "TRY_CAST(CAST(COLUMNS(*) AS VARCHAR) AS DOUBLE)"
    fine = f"(({value} - floor({value})) * {BITS}::DOUBLE)"
    finest = f"(({fine} - floor({fine})) * {BITS}::DOUBLE)"
    exact = " || '/' || ".join(f"CAST(CAST(floor({x}) AS BIGINT) AS VARCHAR)" for x in (value, fine, finest))
    text = f"CASE WHEN typeof(COLUMNS(*)) = 'DOUBLE' THEN {exact} ELSE CAST(COLUMNS(*) AS VARCHAR) END"
    total = lambda x: f"CAST(SUM(CAST(CAST('0x' || substr(md5({x}), 1, 12) AS BIGINT) AS HUGEINT)) AS VARCHAR)"
    cells = f"(SELECT * FROM (SELECT row_number() OVER () AS row_number_, * FROM (SELECT {text} FROM {{{table}}})) UNPIVOT INCLUDE NULLS (value FOR column_name IN (COLUMNS(* EXCLUDE (row_number_)))))"
    whole = f"SELECT string_agg(column_name || '=' || coalesce(value, 'null'), '|' ORDER BY column_name) AS whole FROM {cells} GROUP BY row_number_"
    return f"""
        SELECT '{table}' AS table_name, COUNT(*) AS row_count, column_name, COUNT(value) AS value_count, {total("value")} AS checksum,
               (SELECT {total("whole")} FROM ({whole})) AS row_checksum
        FROM {cells} GROUP BY column_name"""
