"""Every registered query against its DuckDB oracle on the smallest tables,
the same comparison the correctness gate makes."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from sigfleet.plans import driver_queries
from tests.conftest import SF_SMOKE
from tools.oracle_check import TABLES, rows_of


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMOKE}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"create view {t} as select * from read_parquet('{p}')")
    return c


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["pump_id", "name", "status_value", "status_time", "power_value", "power_time"]
    assert df.count() > 0


def test_every_query_has_a_name_in_both(spark):
    q, s = entry.queries(), entry.oracle_sql()
    assert set(s) <= set(q)
    assert set(driver_queries.QUERIES) <= set(s)


@pytest.mark.parametrize("name", sorted(driver_queries.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMOKE)
    rows = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(rows) > 0
        return
    rel = con.execute(sql)
    ocols = [d[0] for d in rel.description]
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert rows_of(df.columns, rows) == rows_of(ocols, orows)


TIME_QUERIES = ["format_time_text", "lookback_range", "history_document", "latest_csv", "ingest_twice", "range_scan", "range_carry_in", "history_export", "relative_range", "format_time", "individual_query", "result_document"]


@pytest.mark.parametrize("name", TIME_QUERIES)
def test_time_queries_ignore_session_zone(spark, con, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = entry.queries()[name](spark, SF_SMOKE)
        rows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    rel = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in rel.description]
    assert rows_of(df.columns, rows) == rows_of(ocols, rel.fetchall())
