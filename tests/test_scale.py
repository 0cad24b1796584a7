"""Steps whose cost grew faster than the input: ingest, folders per pump, listings, timers."""

import datetime as dt
import os
import re
from types import SimpleNamespace

from pyspark.sql import functions as F

from sigfleet.plans.ingest import ingest_payloads
from sigfleet.session import LISTING, NO_LOCALITY, short_listing
from sigfleet.sinks import writers
from sigfleet.sources.readings_log import scan_log
from sigfleet.streaming.silence import SilenceProcessor

T = dt.datetime(2024, 1, 10)


def test_an_ingest_computes_its_payloads_once(spark, tmp):
    n = spark.sparkContext.accumulator(0)

    @F.udf("binary")
    def body(i):
        n.add(1)
        return b'[{"time": "2024-01-10T00:00:00Z", "value": 1.5, "validity": 0}, 5]' if i % 3 else b"{"

    landed = spark.range(30).select(
        F.col("id").cast("string").alias("pump_id"), F.lit("status").alias("signal"), F.lit(False).alias("detailed"),
        F.lit(T).cast("timestamp_ntz").alias("fetched_at"), F.lit(200).alias("http_status"),
        F.lit(None).cast("string").alias("error"), body.asNondeterministic()("id").alias("body"),
    )
    ingest_payloads(landed, f"{tmp}/readings", f"{tmp}/outcomes")
    assert n.value == 30
    rows = scan_log(spark, f"{tmp}/readings").collect()
    assert sorted(int(r.pump_id) for r in rows) == [i for i in range(30) if i % 3]
    assert {(r.time, r.value, r.pos) for r in rows} == {(T, 1.5, 0)}
    found = spark.read.parquet(f"{tmp}/outcomes").groupBy("outcome", "is_nonempty").count().collect()
    assert {tuple(r) for r in found} == {("ok", True, 20), ("malformed", False, 10)}


def test_folders_per_pump_are_dealt_over_tasks(spark, tmp):
    df = spark.range(200).select((F.col("id") % 40).alias("pump_id"), F.col("id").alias("value")).coalesce(1)
    writers.write_output(df, f"{tmp}/out", fmt="csv", separate_files=True, now=T)
    parts = [(d, re.match(r"part-(\d+)", f)) for d, _, names in os.walk(f"{tmp}/out") for f in names]
    files = [(d, m[1]) for d, m in parts if m]
    assert len(files) == len({d for d, _ in files}) == 40  # a pump is whole
    assert len({task for _, task in files}) > 1
    assert spark.read.csv(f"{tmp}/out", header=True).count() == 200


def test_folders_are_listed_by_few_tasks(spark, tmp):
    for i in range(150):
        os.makedirs(f"{tmp}/in/k={i}")
        open(f"{tmp}/in/k={i}/x", "wb").write(b"1")
    before = [spark.conf.get(k, None) for k in (LISTING, NO_LOCALITY)]
    sc = spark.sparkContext
    sc.setJobGroup("short-listing", "")
    try:
        with short_listing(spark):
            files = spark.read.format("binaryFile").load(f"{tmp}/in")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup("short-listing") for s in tracker.getJobInfo(j).stageIds]
    assert 0 < sum(tracker.getStageInfo(s).numTasks for s in stages) <= 64
    assert files.count() == 150
    assert [spark.conf.get(k, None) for k in (LISTING, NO_LOCALITY)] == before


def test_timers_are_listed_for_speaking_series_alone():
    calls, state = [], SimpleNamespace(row=None)
    latest = SimpleNamespace(get=lambda: state.row, update=lambda row: setattr(state, "row", row))
    handle = SimpleNamespace(
        getValueState=lambda *a, **k: latest, registerTimer=lambda t: calls.append(("set", t)),
        listTimers=lambda: calls.append("list") or [7], deleteTimer=lambda t: calls.append(("drop", t)),
    )
    p = SilenceProcessor(1000, 60_000, "none")
    p.init(handle)
    at = lambda ms: SimpleNamespace(getCurrentProcessingTimeInMs=lambda: ms)
    row = SimpleNamespace(time=T, pos=0, value=1.0)
    key = ("a", "status", False)
    assert [r.label for r in p.handleInputRows(key, iter([row]), at(0))] == ["1.0"]
    assert calls == [("set", 1000)]  # new
    assert list(p.handleInputRows(key, iter([row]), at(500))) == []
    assert calls[1:] == ["list", ("drop", 7), ("set", 1500)]  # speaking
    assert [r.label for r in p.handleExpiredTimer(key, at(1500), None)] == ["none"]
    assert [r.label for r in p.handleInputRows(key, iter([row]), at(2000))] == ["1.0"]
    assert calls[4:] == [("set", 3000)]  # silent
    short = SilenceProcessor(1000, 10, "none")  # forgets before its timer
    short.init(handle)
    state.row = None
    list(short.handleInputRows(key, iter([row]), at(0)))
    assert calls[5:] == ["list", ("drop", 7), ("set", 1000)]
