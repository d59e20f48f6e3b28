"""The batch jobs, for spark-submit: enrich, ingest, build, export, report.

Each job reads one folder and writes another, so they can run hours apart and on different clusters::

    spark-submit --py-files skyledger.zip skyledger/jobs.py ingest  /landing   /lake/raw
    spark-submit --py-files skyledger.zip skyledger/jobs.py build   /lake/raw  /lake/warehouse
    spark-submit --py-files skyledger.zip skyledger/jobs.py export  /lake/warehouse  /lake/exports
    spark-submit --py-files skyledger.zip skyledger/jobs.py report  /lake/warehouse  upsell
"""

from __future__ import annotations

import argparse
import json
import posixpath
from collections.abc import Iterator, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from skyledger.operators.enrich import enrich_customers, enrich_flights, loyalty_accrual, score_texts
from skyledger.plans.serving import reports
from skyledger.plans.warehouse import MARTS, METRICS, Warehouse
from skyledger.sources.schemas import RAW_TABLES
from skyledger.sources.tables import export_tables, ingest_raw, read_raw, records, table_profile, write_csv, write_parquet
from skyledger.sources.versions import read_stored

TEXTS = {"customer_reviews": "review_text", "support_tickets": "ticket_text"}
METRICS_DATABASE, MARTS_DATABASE = "main_intermediate", "main_marts"


def open_tables(spark: SparkSession, location: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """The stored tables found below a location; names without one are left out."""
    found = {name: read_stored(spark, posixpath.join(location, name)) for name in names}
    return {name: df for name, df in found.items() if df is not None}


def open_warehouse(spark: SparkSession, location: str) -> dict[str, DataFrame]:
    """The stored metric tables and marts of a build."""
    return {
        **open_tables(spark, posixpath.join(location, METRICS_DATABASE), METRICS),
        **open_tables(spark, posixpath.join(location, MARTS_DATABASE), MARTS),
    }


def enrich(
    spark: SparkSession,
    source: str,
    target: str,
    as_of: str | None = None,
    multi_line: bool = False,
    parquet: bool = False,
    salts: int = 1,
) -> list[str]:
    """Complete the customer and flight feeds and write all feeds, as CSV or as Parquet.

    Loyalty is accrued when there is no such feed. Reviews and tickets without a sentiment get one when the source
    holds a ``lexicon.csv`` of words and polarities. A birth date that is no date becomes NULL.
    """
    lenient = {"customers": ("birth_date",)}
    feeds = {n: read_raw(spark, source, n, multi_line=multi_line, as_text=lenient.get(n, ())) for n in RAW_TABLES}
    feeds = {name: df for name, df in feeds.items() if df is not None}
    if "customers" in feeds:
        feeds["customers"] = enrich_customers(feeds["customers"], as_of)
    if "flights" in feeds and "routes" in feeds:
        feeds["flights"] = enrich_flights(feeds["flights"], feeds["routes"])
    if "loyalty_activity" not in feeds and "customers" in feeds and "bookings" in feeds:
        feeds["loyalty_activity"] = loyalty_accrual(feeds["customers"], feeds["bookings"])
    lexicon = read_raw(spark, source, "lexicon")
    for name, text in TEXTS.items():
        if lexicon is not None and name in feeds and "sentiment_score" not in feeds[name].columns:
            feeds[name] = score_texts(feeds[name], lexicon, text, salts)
    for name, df in feeds.items():
        if parquet:
            write_parquet(df, posixpath.join(target, f"{name}.parquet"))
        else:
            write_csv(df, posixpath.join(target, f"{name}.csv"))
    return list(feeds)


def ingest(spark: SparkSession, source: str, target: str, multi_line: bool = False, infer: bool = False) -> dict:
    """Store the feeds as tables and report their size and the absent ones."""
    stored, absent = ingest_raw(spark, source, "raw", target, multi_line=multi_line, infer=infer)
    return {"loaded": list(records(table_profile(stored))), "absent": absent}


def layout(pairs: Sequence[str] | None) -> dict[str, str]:
    """Folder columns by table from texts such as ``fact_bookings=flight_year``."""
    return dict(p.split("=", 1) for p in pairs or ())


def build(
    spark: SparkSession, source: str, target: str, as_of: str | None = None, partition: Sequence[str] | None = None
) -> list[str]:
    """Build the warehouse from the ingested feeds."""
    raw = open_tables(spark, source, RAW_TABLES)
    wh = Warehouse(raw, as_of)
    return list(wh.store(spark, target, METRICS_DATABASE, MARTS_DATABASE, layout(partition)))


def export(spark: SparkSession, source: str, target: str, partition: Sequence[str] | None = None) -> dict:
    """Export the warehouse tables as Parquet and report the counts and the absent tables."""
    counts, absent = export_tables(open_warehouse(spark, source), target, partition_by=layout(partition))
    return {"exported": list(records(counts)), "absent": absent}


def report(spark: SparkSession, source: str, name: str, output: str | None = None) -> Iterator[dict] | dict:
    """One report as records, or written to a folder as JSON lines."""
    found = reports(open_warehouse(spark, source))[name]
    if output is None:
        return records(found)
    found.write.mode("overwrite").json(output)
    return {"report": name, "output": output}


def show(result) -> None:
    """Print a result as JSON, records one by one."""
    as_json = partial(json.dumps, ensure_ascii=False, default=str)
    if not isinstance(result, Iterator):
        print(as_json(result, indent=2))
        return
    print("[", end="")
    for i, record in enumerate(result):
        print("," if i else "", as_json(record), sep="\n", end="")
    print("\n]")


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    jobs = parser.add_subparsers(dest="job", required=True)
    for name, run, second in (
        ("enrich", enrich, "target"),
        ("ingest", ingest, "target"),
        ("build", build, "target"),
        ("export", export, "target"),
        ("report", report, "name"),
    ):
        job = jobs.add_parser(name, help=run.__doc__.splitlines()[0])
        job.add_argument("source")
        job.add_argument(second)
        if name in ("enrich", "build"):
            job.add_argument("--as-of", help="reporting date, today when not given")
        if name in ("enrich", "ingest"):
            job.add_argument("--multi-line", action="store_true", help="CSV with quoted line breaks; a file that has any is one task")
        if name == "enrich":
            job.add_argument("--parquet", action="store_true", help="write Parquet, which keeps line breaks and splits")
            job.add_argument("--salts", type=int, default=1, help="tasks that a frequent word of a large lexicon gets from the outset")
        if name == "ingest":
            job.add_argument("--infer", action="store_true", help="infer types instead of the declared ones")
        if name in ("build", "export"):
            job.add_argument("--partition", action="append", metavar="TABLE=COLUMN", help="folder column of a table")
        if name == "report":
            job.add_argument("--output", help="folder for the records instead of standard output")
        job.set_defaults(run=run)
    options = vars(parser.parse_args(argv))
    job, run = options.pop("job"), options.pop("run")
    spark = SparkSession.builder.appName(f"skyledger {job}").getOrCreate()
    show(run(spark, **options))


if __name__ == "__main__":
    main()
