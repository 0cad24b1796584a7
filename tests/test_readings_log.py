"""The append log of readings: lossless, repeat-safe, compacted in steps."""

import os
from collections import Counter

import pyarrow.parquet as pq
import pytest

from sigfleet.sources import readings_log as log
from sigfleet.sources.readings_table import merge_readings, write_readings
from tests.conftest import READINGS_DDL, T

COLS = ["pump_id", "signal", "time", "value", "pos"]


def rows_of(df):
    return Counter(tuple(r[c] for c in COLS) for r in df.collect())


def landing(spark, rows):
    """``rows`` of ``(pump, time, value, pos, payload)``."""
    full = [(p, "status", False, T(t) if t else None, v, 0, i, pay) for p, t, v, i, pay in rows]
    return spark.createDataFrame(full, READINGS_DDL + ", payload string")


A = [
    ("a", "2024-01-01 10:00:00", 1.0, 0, "p1"), ("a", "2024-01-01 10:00:00", 2.0, 1, "p1"),
    ("a", "2024-01-01 10:00:00", 2.0, 1, "p1"), ("a", None, 5.0, 2, "p1"), ("a", None, 5.0, 3, "p1"),
    (None, "2024-01-02 10:00:00", None, 0, "p2"),
]
B = [
    ("a", "2024-01-01 10:00:00", 9.0, 0, "p3"), ("a", "2024-01-03 10:00:00", 4.0, 1, "p3"),
    ("a", None, 5.0, 2, "p3"), ("b", None, None, 0, "p3"),
]


def current(landings):
    """Plain form: the newest landing of a key, every payload's timeless readings once."""
    out, newest, payloads = Counter(), {}, {}
    for n, rows in enumerate(landings):
        for r in rows:
            if r[1]:
                newest[r[0], r[1]] = n
            else:
                payloads[r[0], r[4], r[3]] = n
    for n, rows in enumerate(landings):
        for p, t, v, i, pay in rows:
            if newest[p, t] == n if t else payloads[p, pay, i] == n:
                out[p, "status", T(t) if t else None, v, i] += 1
    return out


@pytest.mark.parametrize("order", [[A], [A, B], [A, B, A], [B, A, A], [A, A, A]])
def test_landings_lose_nothing_and_repeat_safely(spark, tmp, order):
    path = f"{tmp}/log"
    for rows in order:
        log.append_readings(landing(spark, rows), path, files=2)
    want = current(order)
    assert rows_of(log.scan_log(spark, path)) == want
    log.compact(spark, path, files=2)
    assert log.runs(spark, path) == [(len(order), "base")]
    assert rows_of(log.scan_log(spark, path)) == want
    log.append_readings(landing(spark, order[-1]), path, files=1)
    assert rows_of(log.scan_log(spark, path)) == want


def test_a_landing_keeps_all_of_its_readings(spark, tmp):
    log.append_readings(landing(spark, A), f"{tmp}/log")
    assert sum(rows_of(log.scan_log(spark, f"{tmp}/log")).values()) == len(A)


def test_stopped_steps_are_repeated(spark, tmp):
    path = f"{tmp}/log"
    log.append_readings(landing(spark, A), path, run=1)
    log.append_readings(landing(spark, B), path, run=2)
    want = current([A, B])
    os.remove(f"{path}/run=2-add/_SUCCESS")  # stopped before the landing was complete
    assert rows_of(log.scan_log(spark, path)) == current([A])
    log.append_readings(landing(spark, B), path, run=2)
    assert rows_of(log.scan_log(spark, path)) == want
    log.compact(spark, path, drop=False)  # stopped between the two steps
    assert log.runs(spark, path) == [(1, "add"), (2, "add"), (2, "base")]
    assert rows_of(log.scan_log(spark, path)) == want
    os.remove(f"{path}/run=2-base/_SUCCESS")  # or before the base was complete
    assert rows_of(log.scan_log(spark, path)) == want
    log.compact(spark, path)
    log.compact(spark, path)
    assert log.runs(spark, path) == [(2, "base")]
    assert rows_of(log.scan_log(spark, path)) == want


def test_predicates_reach_the_scan_and_landings_are_not_rewritten(spark, tmp):
    from tests.test_plans import plan

    path = f"{tmp}/log"
    log.append_readings(landing(spark, A), path)
    before = {f: os.path.getmtime(f"{path}/run=1-add/{f}") for f in os.listdir(f"{path}/run=1-add")}
    log.append_readings(landing(spark, B), path)
    assert before == {f: os.path.getmtime(f"{path}/run=1-add/{f}") for f in os.listdir(f"{path}/run=1-add")}
    df = log.scan_log(spark, path, signals=["status"], pump_ids=["a"], start=T("2024-01-01"), end=T("2024-01-02"))
    p = plan(df)
    assert "signal" in [x for x in p.splitlines() if "PartitionFilters" in x][0]
    pushed = [x for x in p.splitlines() if "PushedFilters" in x][0]
    assert "pump_id" in pushed and "time" in pushed
    assert {r.value for r in df.collect()} == {9.0}


def test_empty_log(spark, tmp):
    assert log.scan_log(spark, f"{tmp}/none").collect() == []
    assert log.compact(spark, f"{tmp}/none") is None
    log.append_readings(landing(spark, A).limit(0), f"{tmp}/log")
    assert log.scan_log(spark, f"{tmp}/log").collect() == []


def test_merge_keeps_null_and_equal_times(spark, tmp):
    """The table that replaces days: nothing of one landing is lost either."""
    path = f"{tmp}/table"
    for rows in (A, A):
        merge_readings(landing(spark, rows), path, files=1)
        assert rows_of(spark.read.parquet(path)) == current([A])
    merge_readings(landing(spark, B), path, files=1)
    got = rows_of(spark.read.parquet(path))
    assert got["a", "status", T("2024-01-01 10:00:00"), 9.0, 0] == 1
    assert not any(k[2] == T("2024-01-01 10:00:00") and k[3] != 9.0 for k in got)
    assert sum(n for k, n in got.items() if k[2] is None) == 3  # pos 2 of both landings is one reading


def test_pump_lookup_skips_row_groups(spark, tmp):
    """A Bloom filter tells an absent pump from ranges that cover it."""
    path = f"{tmp}/table"
    rows = [(f"{i:04d}", "2024-01-01 10:00:00", float(i), 0, "p") for i in range(0, 2_000, 2)]
    write_readings(landing(spark, rows), path, files=1)
    files = [f"{d}/{f}" for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")]
    meta = pq.ParquetFile(files[0]).metadata.row_group(0)
    names = [meta.column(i).path_in_schema for i in range(meta.num_columns)]
    stats = meta.column(names.index("pump_id")).statistics
    assert stats.min < "1001" < stats.max

    def scanned(pump):
        df = spark.read.parquet(path).where(f"pump_id = '{pump}'")
        assert len(df.collect()) == (int(pump) % 2 == 0)
        found = []
        todo = [df._jdf.queryExecution().executedPlan()]
        while todo:
            node = todo.pop()
            if "AdaptiveSparkPlan" in node.nodeName():
                node = node.executedPlan()
            metric = node.metrics().get("numOutputRows")
            if node.nodeName().startswith("Scan") and metric.isDefined():
                found.append(metric.get().value())
            kids = node.children()
            todo += [kids.apply(i) for i in range(kids.size())]
        return sum(found)

    assert scanned("1001") == 0  # absent, inside the range: the row group is skipped
    assert scanned("1000") > 0
