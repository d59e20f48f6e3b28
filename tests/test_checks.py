"""Every registered query against its check statement, in whole tables of two generated sizes."""

import hashlib

import duckdb
import pytest

import __spark_entry__ as registry
from compare import connect, duck_rows, spark_rows
from testbed.contents import contents, contents_sql

FOLDERS = ("/root/testdata/sf0.001", "/root/testdata/sf0.01")


@pytest.fixture(scope="module", params=FOLDERS)
def tables(request):
    return request.param, connect(request.param)


def test_every_query_has_a_check():
    assert set(registry.warehouse_queries()) <= set(registry.oracle_sql())
    assert len(registry.warehouse_queries()) == 44


@pytest.mark.parametrize("name", list(registry.warehouse_queries()))
def test_matches_check(spark, tables, name):
    folder, con = tables
    got = spark_rows(registry.queries()[name](spark, folder))
    want = duck_rows(con, registry.oracle_sql()[name])
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1]) > 0
    assert got[1] == want[1]


def test_contents_tell_where_values_stand(spark):
    told = lambda rows: sorted(tuple(r) for r in contents({"t": spark.createDataFrame(rows, "a int, x double, s string")}).collect())
    rows = [(1, 0.5, "p"), (2, 1e-9, "q"), (3, None, None), (4, -7.25, "")]
    assert told(rows) == told(rows[::-1])
    swapped = [(1, 1e-9, "p"), (2, 0.5, "q"), *rows[2:]]
    assert [r[:-1] for r in told(swapped)] == [r[:-1] for r in told(rows)] and told(swapped) != told(rows)
    for changed in ((2, 1.0000000000000002e-9, "q"), (2, 1e-9 + 1e-12, "q"), (2, None, "q")):
        assert told([rows[0], changed, *rows[2:]]) != told(rows)


def test_contents_are_told_alike(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT * FROM (VALUES (1, 0.1::DOUBLE, 'p|', DATE '2024-01-05'), (2, -1e-20::DOUBLE, NULL, NULL), (3, 123456789.987654321::DOUBLE, '', DATE '1999-12-31')) v(a, x, s, d)")
    df = spark.createDataFrame([tuple(r) for r in con.execute("SELECT * FROM t").fetchall()], "a int, x double, s string, d date")
    assert spark_rows(contents({"t": df})) == duck_rows(con, contents_sql("t").replace("{t}", "t"))


def test_entry(spark):
    assert registry.entry(spark).count() == 25


def test_check_sums_are_added_up_as_longs(frame):
    values = [f"v{i}" for i in range(500)] + [None]
    found = contents({"t": frame([(v,) for v in values], "c string")})
    digest = lambda text: int(hashlib.md5(text.encode()).hexdigest()[:12], 16)
    row = found.collect()[0]
    assert row["checksum"] == str(sum(digest(v) for v in values[:-1]))
    assert row["row_checksum"] == str(sum(digest(f"c={v or 'null'}") for v in values))
    assert "sum(cast(conv(" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert contents({"t": frame([(None,)], "c string")}).collect()[0]["checksum"] is None
