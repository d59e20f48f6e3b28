"""Files in, tables and files out, and the jobs from end to end."""

import datetime as dt
import json
import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import rows as R
from skyledger import jobs
from skyledger.plans.warehouse import Warehouse
from skyledger.sources import storage, tables, versions
from skyledger.sources.schemas import RAW_COLUMNS, RAW_TABLES


def test_read_raw_maps_columns_by_name(spark, tmp_path):
    (tmp_path / "customers.csv").write_text(
        "age,customer_id,loyalty_member,signup_date,loyalty_tier,note,first_name\n"
        '45.0,C1,True,2024-01-05,,"said ""yes"", twice",Aïcha\n'
        ",C2,False,,Gold,x,\n",
        encoding="utf-8",
    )
    got = tables.read_raw(spark, str(tmp_path), "customers")
    assert got.dtypes == [
        ("age", "double"),
        ("customer_id", "string"),
        ("loyalty_member", "boolean"),
        ("signup_date", "date"),
        ("loyalty_tier", "string"),
        ("note", "string"),
        ("first_name", "string"),
    ]
    assert [tuple(r) for r in got.collect()] == [
        (45.0, "C1", True, dt.date(2024, 1, 5), None, 'said "yes", twice', "Aïcha"),
        (None, "C2", False, None, "Gold", "x", None),
    ]


def test_read_raw_stops_on_a_value_that_does_not_fit(spark, tmp_path):
    (tmp_path / "routes.csv").write_text("route_id,distance_km\nR1,far\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        tables.read_raw(spark, str(tmp_path), "routes").collect()


def test_read_raw_can_infer(spark, tmp_path):
    (tmp_path / "routes.csv").write_text("route_id,distance_km,opened\nR1,350,2024-01-05\n")
    assert tables.read_raw(spark, str(tmp_path), "routes", infer=True).dtypes == [
        ("route_id", "string"),
        ("distance_km", "int"),
        ("opened", "date"),
    ]


def test_read_raw_with_line_breaks_in_quotes(spark, tmp_path):
    (tmp_path / "support_tickets.csv").write_text('ticket_id,ticket_text\nT1,"one\ntwo"\n')
    got = tables.read_raw(spark, str(tmp_path), "support_tickets", multi_line=True)
    assert [tuple(r) for r in got.collect()] == [("T1", "one\ntwo")]


def test_only_files_with_line_breaks_in_quotes_are_read_whole(spark, tmp_path):
    feed = tmp_path / "support_tickets.csv"
    feed.mkdir()
    plain = [f"T{i},text {i}" for i in range(3000)]
    (feed / "a b%20é.csv").write_text("ticket_id,ticket_text\n" + "\n".join(plain) + "\n")
    (feed / "b.csv").write_text('ticket_id,ticket_text\nU1,"one\ntwo ""three"""\nU2,"said ""so"", twice"\n')
    (feed / "c.csv").write_text('ticket_id,ticket_text\nU3,"said ""so"""\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        got = tables.read_raw(spark, str(tmp_path), "support_tickets", multi_line=True)
        parted, whole = tables._by_line_breaks(spark, str(feed))
        assert ([len(parted), len(whole)], whole[0].endswith("b.csv")) == ([2, 1], True)
        # the large plain file is several tasks, and the largest task that reads a file whole is that of b.csv
        assert got.rdd.getNumPartitions() >= 5
        rows = {r["ticket_id"]: r["ticket_text"] for r in got.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 3003 and rows["T2999"] == "text 2999"
    assert (rows["U1"], rows["U2"], rows["U3"]) == ('one\ntwo "three"', 'said "so", twice', 'said "so"')


def test_absent_feed(spark, tmp_path):
    assert tables.read_raw(spark, str(tmp_path), "flights") is None


def test_csv_round_trip_keeps_every_feed(spark, tmp_path):
    for name, df in R.raw_feeds(spark).items():
        tables.write_csv(df, str(tmp_path / f"{name}.csv"))
        back = tables.read_raw(spark, str(tmp_path), name)
        assert back.dtypes == df.dtypes
        assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))


def test_ingest_replaces_tables_and_names_absent_feeds(spark, tmp_path):
    feeds = R.raw_feeds(spark)
    landing, store = str(tmp_path / "landing"), str(tmp_path / "raw")
    for name in ("routes", "bookings"):
        tables.write_csv(feeds[name], f"{landing}/{name}.csv")
    stored, absent = tables.ingest_raw(spark, landing, "ingested", store)
    assert absent == [t for t in RAW_TABLES if t not in ("routes", "bookings")]
    assert spark.table("ingested.routes").count() == 5

    tables.write_csv(feeds["routes"].filter("route_id = 'R1'"), f"{landing}/routes.csv")
    stored, _ = tables.ingest_raw(spark, landing, "ingested", store)
    profile = [tuple(r) for r in tables.table_profile(stored).collect()]
    assert sorted(profile) == [("bookings", 8, 12), ("routes", 1, 6)]


def test_views_are_bound_by_name(spark):
    tables.bind_views({"some_routes": R.feed(spark, "routes", R.ROUTES)})
    assert spark.sql("SELECT count(*) FROM some_routes").first()[0] == 5


def test_stored_warehouse_equals_the_lazy_one(spark, tmp_path):
    lazy = Warehouse(R.raw_feeds(spark), R.AS_OF)
    stored = Warehouse(R.raw_feeds(spark), R.AS_OF).store(spark, str(tmp_path))
    assert len(stored) == 9
    for name, df in stored.items():
        columns = [c for c in df.columns if c != "updated_at"]
        assert df.columns == lazy[name].columns
        assert sorted(map(repr, df.select(columns).collect())) == sorted(map(repr, lazy[name].select(columns).collect()))
    assert spark.table("main_marts.fact_bookings").count() == 7
    assert spark.table("stg_bookings").count() == 7


def test_stored_facts_can_be_pruned_by_year(spark, tmp_path):
    wh = Warehouse(R.raw_feeds(spark), R.AS_OF)
    stored = wh.store(spark, str(tmp_path), "y_intermediate", "y_marts", {"fact_bookings": "flight_year"})
    one_year = stored["fact_bookings"].filter("flight_year = 2024")
    assert one_year.count() == 5
    assert "PartitionFilters: [isnotnull(flight_year" in one_year._jdf.queryExecution().executedPlan().toString()


def test_export_counts_what_was_written(spark, tmp_path):
    wh = Warehouse(R.raw_feeds(spark), R.AS_OF)
    some = {name: wh[name] for name in ("fact_bookings", "dim_routes")}
    counts, absent = tables.export_tables(some, str(tmp_path), partition_by={"fact_bookings": "flight_year"})
    assert sorted(tuple(r) for r in counts.collect()) == [("dim_routes", 4), ("fact_bookings", 7)]
    assert absent == [t for t in tables.EXPORTED_TABLES if t not in some]
    assert (tmp_path / "fact_bookings.parquet" / "flight_year=2024").is_dir()
    assert spark.read.parquet(str(tmp_path / "fact_bookings.parquet")).count() == 7


def test_records_come_one_by_one(spark):
    found = tables.records(spark.range(5).select(F.struct("id").alias("s")))
    assert next(found) == {"s": {"id": 0}}
    assert len(list(found)) == 4


def test_shared_folder(spark, tmp_path):
    first, second = storage.fresh_folder(spark, "x"), storage.fresh_folder(spark, "x")
    assert first != second and first.startswith(storage.shared_folder(spark))


def test_shared_folder_prefers_the_cluster_setting():
    class Conf:
        @staticmethod
        def get(key, default=None):
            return {"spark.checkpoint.dir": "hdfs:///shared"}.get(key, default)

    class Session:
        conf = Conf

    assert storage.shared_folder(Session) == "hdfs:///shared"


def test_shared_folder_is_required_on_a_cluster():
    class Session:
        class conf:
            @staticmethod
            def get(key, default=None):
                return default

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError):
        storage.shared_folder(Session)


def test_jobs_from_feeds_to_reports(spark, tmp_path, capsys):
    source, landing, raw, warehouse, out = (str(tmp_path / d) for d in ("in", "landing", "raw", "wh", "out"))
    for name, df in R.raw_feeds(spark).items():
        if name != "loyalty_activity":
            keep = df.drop("age", "preferred_cabin") if name == "customers" else df
            tables.write_csv(keep, f"{source}/{name}.csv")
    assert set(jobs.enrich(spark, source, landing, R.AS_OF)) == set(RAW_TABLES)
    assert tables.read_raw(spark, landing, "customer_reviews").filter("sentiment_score = 0.5").count() == 1
    loaded = jobs.ingest(spark, landing, raw)
    assert loaded["absent"] == []
    sizes = {r["table_name"]: r["row_count"] for r in loaded["loaded"]}
    assert (sizes["bookings"], sizes["loyalty_activity"]) == (8, 5)
    assert len(jobs.build(spark, raw, warehouse, R.AS_OF)) == 9
    exported = jobs.export(spark, warehouse, out)
    assert exported["absent"] == ["dim_fare_families"]
    assert {r["table_name"]: r["row_count"] for r in exported["exported"]}["fact_flights"] == 7
    upsell = jobs.report(spark, warehouse, "upsell")
    assert [r["segment"] for r in upsell] == ["Budget", "Business"]
    jobs.main(["report", warehouse, "resume"])
    (summary,) = json.loads(capsys.readouterr().out)
    assert list(summary) == ["réseau", "clients", "ancillaires", "recommandation"]
    assert summary["clients"]["total_clients"] == 4
    jobs.main(["report", warehouse, "routes", "--output", f"{out}/routes"])
    assert json.loads(capsys.readouterr().out)["output"] == f"{out}/routes"
    assert spark.read.json(f"{out}/routes").count() == len(list(jobs.report(spark, warehouse, "routes")))


def test_enrich_job_scores_texts_without_sentiment(spark, frame, tmp_path):
    source, landing = str(tmp_path / "in"), str(tmp_path / "out")
    reviews = frame(
        [("V1", 5.0, "Great crew, great seat."), ("V2", 1.0, "Awful"), ("V3", 3.0, None)],
        "review_id string, rating double, review_text string",
    )
    tables.write_csv(reviews, f"{source}/customer_reviews.csv")
    tables.write_csv(frame([("great", 0.8), ("awful", -1.0)], "word string, polarity double"), f"{source}/lexicon.csv")
    assert jobs.enrich(spark, source, landing) == ["customer_reviews"]
    got = tables.read_raw(spark, landing, "customer_reviews")
    assert got.columns == ["review_id", "rating", "review_text", "sentiment_score", "sentiment_label"]
    assert sorted(tuple(r)[3:] for r in got.collect()) == [(-1.0, "negative"), (0.0, "neutral"), (0.8, "positive")]


AWKWARD = ["  padded  ", "two\nlines", 'said "so", twice', "é à ñ", "trailing ", None]


def test_csv_keeps_blanks_line_breaks_quotes_and_accents(spark, frame, tmp_path):
    df = frame([(f"T{i}", t) for i, t in enumerate(AWKWARD)], "ticket_id string, ticket_text string")
    tables.write_csv(df, str(tmp_path / "support_tickets.csv"))
    back = tables.read_raw(spark, str(tmp_path), "support_tickets", multi_line=True)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))


@pytest.mark.parametrize("options", [["--parquet"], []])
def test_jobs_pass_on_texts_with_line_breaks(spark, frame, tmp_path, capsys, options):
    source, landing, raw = (str(tmp_path / d) for d in ("in", "landing", "raw"))
    df = frame([(f"T{i}", t, 0.5) for i, t in enumerate(AWKWARD)], "ticket_id string, ticket_text string, sentiment_score double")
    tables.write_csv(df, f"{source}/support_tickets.csv")
    jobs.main(["enrich", source, landing, "--multi-line", *options])
    jobs.main(["ingest", landing, raw, *([] if options else ["--multi-line"])])
    got = versions.read_stored(spark, f"{raw}/support_tickets").select("ticket_text").collect()
    assert sorted(map(repr, got)) == sorted(map(repr, df.select("ticket_text").collect()))


def test_a_birth_date_that_is_no_date_becomes_null(spark, tmp_path):
    source, landing, raw = (str(tmp_path / d) for d in ("in", "landing", "raw"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "customers.csv").write_text("customer_id,segment,loyalty_tier,birth_date\nC1,Business,,not known\nC2,Budget,Gold,1990-01-01\n")
    jobs.enrich(spark, source, landing, "2024-12-31")
    jobs.ingest(spark, landing, raw)
    got = {r["customer_id"]: (r["birth_date"], r["age"]) for r in versions.read_stored(spark, f"{raw}/customers").collect()}
    assert got == {"C1": (None, None), "C2": (dt.date(1990, 1, 1), 35.0)}


def test_ingest_can_infer_undeclared_columns(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "routes.csv").write_text("route_id,distance_km,opened\nR1,350,2024-01-05\n")
    jobs.main(["ingest", str(tmp_path / "in"), str(tmp_path / "raw"), "--infer"])
    assert dict(versions.read_stored(spark, str(tmp_path / "raw" / "routes")).dtypes)["opened"] == "date"


def test_export_of_a_folder_without_tables(spark, tmp_path):
    assert jobs.export(spark, str(tmp_path / "none"), str(tmp_path / "out")) == {"exported": [], "absent": list(tables.EXPORTED_TABLES)}


def test_a_failed_write_leaves_the_former_table(spark, frame, tmp_path):
    tables.ensure_database(spark, "kept", str(tmp_path / "it's here"))
    tables.replace_table(frame([(1,)], "a int"), "kept", "t", str(tmp_path / "it's here"))
    broken = frame([(1,)], "a int").select(F.raise_error(F.lit("no")).cast("int").alias("a"))
    with pytest.raises(Exception, match="no"):
        tables.replace_table(broken, "kept", "t", str(tmp_path / "it's here"))
    assert [p.name for p in (tmp_path / "it's here").iterdir()] == ["t"]
    assert spark.table("kept.t").collect() == [(1,)]
    tables.replace_table(frame([(2, "x")], "a int, b string"), "kept", "t", str(tmp_path / "it's here"))
    assert spark.table("kept.t").collect() == [(2, "x")]


def test_folders_of_a_column_get_few_files_and_jobs_can_ask_for_them(spark, tmp_path, capsys):
    raw, warehouse, out = (str(tmp_path / d) for d in ("raw", "wh", "out"))
    for name, df in R.raw_feeds(spark).items():
        df.repartition(7).write.parquet(f"{raw}/{name}")
    jobs.main(["build", raw, warehouse, "--as-of", str(R.AS_OF), "--partition", "fact_bookings=flight_year"])
    jobs.main(["export", warehouse, out, "--partition", "fact_flights=flight_year"])
    stored = Path(versions.current(spark, f"{warehouse}/{jobs.MARTS_DATABASE}/fact_bookings"))
    for top in (stored, tmp_path / "out" / "fact_flights.parquet"):
        years = [p for p in top.iterdir() if p.name.startswith("flight_year=")]
        assert years and all(len(list(y.glob("*.parquet"))) == 1 for y in years)


def test_texts_are_scored_row_by_row(frame):
    from skyledger.operators.enrich import score_texts

    feed = frame([("a", "good"), ("a", "bad"), (None, "good bad good"), (None, None), ("b", "good")], "review_id string, review_text string")
    lexicon = frame([("good", 0.8), ("bad", -1.0)], "word string, polarity double")
    got = score_texts(feed, lexicon, "review_text")
    assert sorted(map(repr, ((r[0], r[2]) for r in got.collect()))) == sorted(map(repr, [("a", 0.8), ("a", -1.0), (None, 0.2), (None, 0.0), ("b", 0.8)]))


def test_declared_feeds():
    assert [len(RAW_COLUMNS[t]) for t in RAW_TABLES] == [7, 6, 14, 21, 12, 10, 11, 7]


STEPS = ["make_folder", "make_file", "listed", "delete", "exists"]


def _stored_values(spark, path, name):
    """The values that a reader of the path and one of the name find; each table holds one value in every row."""
    by_path = versions.read_stored(spark, path)
    by_name = spark.table(name) if spark.catalog.tableExists(name) else None
    return [None if df is None else (df.count(), *{r["a"] for r in df.select("a").collect()}) for df in (by_path, by_name)]


def _killed_at(step, call):
    """Run call, but stop it as a kill would at the step of that number; tells whether it got so far."""
    done = 0

    def counted(real):
        def run(*args, **kwargs):
            nonlocal done
            done += 1
            if done == step:
                raise KeyboardInterrupt
            return real(*args, **kwargs)

        return run

    with pytest.MonkeyPatch.context() as patch:
        for name in STEPS:
            patch.setattr(storage, name, counted(getattr(storage, name)))
        patch.setattr(tables, "_bind", counted(tables._bind))
        try:
            call()
        except KeyboardInterrupt:
            return True
    return False


def test_a_writer_killed_between_any_two_steps_leaves_a_whole_table(spark, tmp_path):
    tables.ensure_database(spark, "killed", str(tmp_path))
    of = lambda a, extra: spark.range(50).select(F.lit(a).alias("a"), *([F.lit("x").alias("b")] if extra else []))
    tables.replace_table(of(0, False), "killed", "t", str(tmp_path))
    seen, step, last = set(), 1, 0
    while _killed_at(step, lambda: tables.replace_table(of(step, step % 2 == 1), "killed", "t", str(tmp_path), keep_hours=0)):
        by_path, by_name = _stored_values(spark, str(tmp_path / "t"), "killed.t")
        assert by_path in ((50, last), (50, step)) and by_name in ((50, last), (50, step))
        last = by_path[1]
        seen.add((by_path[1] == step, by_name[1] == step))
        tables.replace_table(of(last, False), "killed", "t", str(tmp_path))
        step += 1
    assert seen >= {(False, False), (True, False), (True, True)}
    assert _stored_values(spark, str(tmp_path / "t"), "killed.t") == [(50, step), (50, step)]


def test_a_first_writer_that_is_killed_leaves_no_table(spark, tmp_path):
    tables.ensure_database(spark, "unborn", str(tmp_path))
    versions.write_version(spark.range(3), str(tmp_path / "t"))
    assert versions.read_stored(spark, str(tmp_path / "t")) is None
    assert jobs.open_tables(spark, str(tmp_path), ["t", "other"]) == {}


def test_readers_meet_a_whole_table_while_it_is_replaced(spark, tmp_path):
    tables.ensure_database(spark, "busy", str(tmp_path))
    of = lambda a: spark.range(1000).repartition(4).select(F.lit(a).alias("a"))
    tables.replace_table(of(0), "busy", "t", str(tmp_path))
    found, stop, failed = [], threading.Event(), []

    def read():
        try:
            while not stop.is_set():
                found.append(_stored_values(spark, str(tmp_path / "t"), "busy.t"))
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    for a in range(1, 9):
        tables.replace_table(of(a), "busy", "t", str(tmp_path))
    stop.set()
    reader.join()
    assert not failed
    assert len(found) > 2 and all(len(v) == 2 and v[0] == 1000 for both in found for v in both)


def test_superseded_versions_go_after_their_time(spark, tmp_path):
    tables.ensure_database(spark, "aged", str(tmp_path))
    for a in range(3):
        tables.replace_table(spark.range(a + 1), "aged", "t", str(tmp_path))
    (tmp_path / "t" / "vleft").mkdir()
    folders = lambda: [p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("v")]
    assert len(folders()) == 4
    versions.drop_superseded(spark, str(tmp_path / "t"), keep_hours=0)
    assert [versions.current(spark, str(tmp_path / "t"))] == [str(tmp_path / "t" / f) for f in folders()]
    assert versions.read_stored(spark, str(tmp_path / "t")).count() == 3


def test_names_that_are_words_of_sql_and_paths_with_odd_characters(spark, tmp_path):
    where = str(tmp_path / "it's `odd`")
    tables.ensure_database(spark, "order", where)
    tables.replace_table(spark.range(2), "order", "table", where)
    assert spark.table("`order`.`table`").count() == 2
    tables.replace_table(spark.range(3), "order", "table")
    assert spark.table("`order`.`table`").count() == 3


def test_storing_reads_the_raw_bookings_once_and_leaves_no_copy(spark, tmp_path):
    raw, read = dict(R.raw_feeds(spark)), spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def counted(_):
        read.add(1)
        return True

    rows = raw["bookings"].filter("booking_id is not null").count()
    raw["bookings"] = raw["bookings"].filter(counted("booking_id"))
    wh = Warehouse(raw, R.AS_OF)
    planned = wh.int_customer_metrics.count(), wh.stg_bookings
    read.value = 0
    stored = wh.store(spark, str(tmp_path), "once_intermediate", "once_marts")
    assert read.value == rows
    assert stored["int_customer_metrics"].count() == planned[0] and wh.stg_bookings is planned[1]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["once_intermediate", "once_marts"]
    want = sorted(map(str, Warehouse(R.raw_feeds(spark), R.AS_OF).int_customer_metrics.collect()))
    assert sorted(map(str, stored["int_customer_metrics"].collect())) == want
