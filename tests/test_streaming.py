import datetime as dt
import pathlib
import time

from pyspark.sql import functions as F

from sigfleet.operators.latest import latest_per_signal
from sigfleet.schemas import LANDED_SCHEMA
from sigfleet.session import setting, work_path
from sigfleet.sinks import named_files
from sigfleet.sources.payloads import read_landed_files, readings_from_landed
from sigfleet.streaming import monitors
from sigfleet.streaming.silence import latest_of_batches
from tests.conftest import READINGS_DDL, T


def land(spark, rows, path):
    df = spark.createDataFrame(rows, READINGS_DDL)
    df.write.mode("append").parquet(path)


def batch1():
    return [
        ("p1", "status", False, T("2024-01-01 00:00:00"), 1.0, 0, 0),
        ("p1", "status", False, T("2024-01-01 01:00:00"), 0.0, 0, 1),
        ("p2", "rawpower", False, T("2024-01-01 00:00:00"), 5.0, 0, 0),
        ("p2", "fault", False, T("2024-01-01 00:05:00"), 9.0, 0, 0),
    ]


def batch2():
    return [
        ("p1", "status", False, T("2024-01-01 00:30:00"), 7.0, 0, 2),  # older than p1's latest
        ("p2", "rawpower", False, T("2024-01-02 00:00:00"), 6.0, 0, 1),
        ("p3", "status", False, T("2024-01-02 00:00:00"), 3.0, 0, 0),
    ]


def stream(spark, path):
    return spark.readStream.schema(READINGS_DDL).parquet(path)


def as_set(df):
    return {(r.pump_id, r.signal, r.value, r.time) for r in df.collect()}


def test_latest_stream_equals_batch_across_restarts(spark):
    src = work_path(spark, "test-src")
    sink = work_path(spark, "test-sink")
    ck = work_path(spark, "test-ck")
    land(spark, batch1(), src)
    monitors.start_latest_monitor(stream(spark, src), sink, ck, {"availableNow": True}).awaitTermination()
    land(spark, batch2(), src)
    land(spark, batch1(), src)  # re-landing the same payload
    monitors.start_latest_monitor(stream(spark, src), sink, ck, {"availableNow": True}).awaitTermination()
    got = as_set(monitors.read_latest(spark, sink))
    everything = spark.read.parquet(src)
    want = as_set(latest_per_signal(everything).select("pump_id", "signal", "value", "time"))
    assert got == want
    assert ("p1", "status", 0.0, dt.datetime(2024, 1, 1, 1, 0)) in got
    # every batch wrote a whole snapshot; the newest alone is the answer
    snaps = monitors._snapshot_ids(spark, sink)
    assert len(snaps) >= 2
    last = spark.read.parquet(f"{sink}/batch_id={snaps[-1]}")
    assert last.count() == len(want)


def test_fault_alerts_stream(spark, mk_pumps):
    src = work_path(spark, "test-src")
    land(spark, batch1(), src)
    land(spark, [(p, s, d, t, v, q, pos + 3) for p, s, d, t, v, q, pos in batch1()], src)  # shifted repeat: alerts once
    chosen = mk_pumps([("p2", "south3 u1")])
    sink = monitors.run_available(spark, "test-alerts", monitors.start_fault_alerts, stream(spark, src), chosen)
    rows = monitors.read_alerts(spark, sink).collect()
    assert [(r.pump_id, r.name, r.value) for r in rows] == [("p2", "south3 u1", 9.0)]


def test_fault_alerts_late_first_landing(spark, mk_pumps):
    src, sink, ck = (work_path(spark, f"test-late-{x}") for x in ("src", "sink", "ck"))
    chosen = mk_pumps([("p1", "n1"), ("p2", "n2")])

    def fault(pump, time, pos):
        return (pump, "fault", False, T(time), 9.0, 0, pos)

    batches = [
        [fault("p1", "2024-02-01 00:00:00", 0), fault("p2", "2094-01-01 00:00:00", 0)],  # a clock ahead
        [fault("p1", "2024-02-01 00:01:00", 0)],
        [fault("p1", "2024-01-01 00:00:00", 0), fault("p2", "2024-02-01 00:00:00", 1)],  # late, first time
        [fault("p1", "2024-01-01 00:00:00", 5), fault("p1", "2024-02-01 00:00:00", 6)],  # repeats
    ]
    for rows in batches:
        land(spark, rows, src)
        monitors.start_fault_alerts(stream(spark, src), chosen, sink, ck, {"availableNow": True}).awaitTermination()
    got = sorted((r.pump_id, r.time) for r in monitors.read_alerts(spark, sink).collect())
    assert got == sorted({(r[0], r[3]) for rows in batches for r in rows})


def test_landed_rows_and_labels(spark, mk_pumps):
    body = b'[{"time": "2031-02-03T04:05:06Z", "value": 2.5, "validity": 0}]'
    src = work_path(spark, "test-src")
    rows = [("p1", "status", False, T("2031-02-03 05:00:00"), 200, None, body)]
    spark.createDataFrame(rows, LANDED_SCHEMA).write.parquet(src)
    stream_ = monitors.landed_readings_stream(spark, src)
    sink = monitors.run_available(spark, "test-landed", monitors.start_latest_monitor, stream_)
    shown = monitors.latest_labels(spark, sink, mk_pumps([("p1", "n1"), ("p2", None)])).collect()
    assert {(r.pump_id, r.name, r.value) for r in shown} == {("p1", "n1", "2.5"), ("p2", "Sin nombre", "sin datos")}


def test_heartbeat_per_poll(spark, mk_pumps):
    src = work_path(spark, "test-src")
    land(spark, batch1(), src)
    chosen = mk_pumps([("p1", "n1"), ("p2", "n2"), ("p9", "silent")])
    sink = monitors.run_available(spark, "test-hb", monitors.start_heartbeat, stream(spark, src), chosen)
    got = {(r.pump_id, r.status, r.power) for r in spark.read.parquet(sink).collect()}
    assert got == {("p1", "OK", "Error"), ("p2", "Error", "OK"), ("p9", "Error", "Error")}


def test_alert_sink_is_read_by_day_only(spark, mk_pumps, monkeypatch):
    """What a batch looks at does not grow with the age of the monitor."""
    src, sink, ck = (work_path(spark, f"test-days-{x}") for x in ("src", "sink", "ck"))
    chosen = mk_pumps([("p1", "n1")])
    looked = []
    plain = monitors._day_folders

    def watched(session, path, days):
        found = plain(session, path, days)
        looked.append([f.rsplit("=", 1)[1] for f in found])
        return found

    monkeypatch.setattr(monitors, "_day_folders", watched)
    days = [f"2024-01-{d:02d}" for d in (1, 2, 3, 4, 2)]
    for i, d in enumerate(days):
        land(spark, [("p1", "fault", False, T(f"{d} 10:00:00"), 1.0, 0, i)], src)
        monitors.start_fault_alerts(stream(spark, src), chosen, sink, ck, {"availableNow": True}).awaitTermination()
    assert looked == [[], [], [], [], ["2024-01-02"]]
    assert monitors.read_alerts(spark, sink).count() == 4


def test_alerts_of_a_batch_run_again(spark, mk_pumps):
    """A batch that stopped halfway neither loses nor doubles an alert."""
    sink = work_path(spark, "test-again")
    rows = [("p1", "fault", False, T(f"2024-01-0{d} 10:00:00"), 1.0, 0, d) for d in (1, 2)] + [
        ("p1", "fault", False, None, 1.0, 0, 9)
    ]
    batch = spark.createDataFrame(rows, READINGS_DDL).join(mk_pumps([("p1", "n")]).select("pump_id", "name"), "pump_id")
    write = monitors._write_alerts(sink)
    write(batch.where("pos = 1"), 0)  # what the stopped batch had written
    write(batch, 0)
    write(batch, 1)
    assert sorted(r.pos for r in monitors.read_alerts(spark, sink).collect()) == [1, 2, 9]
    assert monitors.read_alerts(spark, work_path(spark, "never")).collect() == []


def test_heartbeat_run_of_polls(spark, mk_pumps):
    src, sink, ck = (work_path(spark, f"test-polls-{x}") for x in ("src", "sink", "ck"))
    land(spark, [], src)
    chosen = mk_pumps([("p1", "n1"), ("p2", "n2")])
    asked = []

    def before(n):
        asked.append(n)
        if n == 3 and asked.count(3) == 1:
            raise RuntimeError("stopped")
        if n in (0, 4):
            land(spark, batch1(), src)

    kw = dict(polls=5, every=0, before=before)
    try:
        monitors.run_heartbeat(stream(spark, src), chosen, sink, ck, **kw)
    except RuntimeError:
        pass
    got = monitors.run_heartbeat(stream(spark, src), chosen, sink, ck, **kw)
    assert asked == [0, 1, 2, 3, 3, 4]
    ok, silent = {("p1", "OK", "Error"), ("p2", "Error", "OK")}, {("p1", "Error", "Error"), ("p2", "Error", "Error")}
    rows = got.collect()
    for n in range(5):
        assert {(r.pump_id, r.status, r.power) for r in rows if r.poll == n} == (ok if n in (0, 4) else silent)


def labels_of(spark, sink):
    return {(r.pump_id, r.signal): (r.label, r.value) for r in monitors.read_labels(spark, sink).collect()}


def wait_for(check, seconds=90):
    end = time.time() + seconds
    while time.time() < end:
        if check():
            return True
        time.sleep(0.3)
    return False


def test_labels_fall_silent_speak_again_and_survive_a_restart(spark):
    src, sink, ck = (work_path(spark, f"test-labels-{x}") for x in ("src", "sink", "ck"))
    land(spark, batch1(), src)
    assert labels_of(spark, sink) == {}

    def start(silent_after, trigger):
        return monitors.start_label_monitor(stream(spark, src), sink, ck, trigger, silent_after)

    # A long patience: values only.
    often = {"processingTime": "3 seconds"}
    monitors.stop_when_idle(start(3600, often))
    p1, power, fault = ("p1", "status"), ("p2", "rawpower"), ("p2", "fault")
    assert labels_of(spark, sink) == {p1: ("0.0", 0.0), power: ("5.0", 5.0), fault: ("9.0", 9.0)}

    # Restarted with little patience: what speaks falls silent without any input.
    q = start(2, often)
    try:
        land(spark, batch2(), src)  # p1's reading is a late one
        p3 = ("p3", "status")
        quiet = {p1: ("sin datos", 0.0), power: ("sin datos", 6.0), fault: ("9.0", 9.0), p3: ("sin datos", 3.0)}
        assert wait_for(lambda: labels_of(spark, sink) == quiet), labels_of(spark, sink)
    finally:
        q.stop()

    # Restarted: a late reading brings p1's value back, unchanged; p3 has a new one.
    land(spark, [("p1", "status", False, T("2023-01-01 00:00:00"), 8.0, 0, 9)], src)
    land(spark, [("p3", "status", False, T("2024-01-05 00:00:00"), None, 0, 1)], src)
    monitors.stop_when_idle(start(3600, often))
    now = {p1: ("0.0", 0.0), power: ("sin datos", 6.0), fault: ("9.0", 9.0), p3: ("sin datos", None)}
    assert labels_of(spark, sink) == now


def test_latest_of_batches_orders_nulls_lowest(spark):
    rows = [
        ("p", "status", False, None, 1.0, 0, 5),
        ("p", "status", False, T("2024-01-01 00:00:00"), 2.0, 0, None),
        ("p", "status", False, T("2024-01-01 00:00:00"), 3.0, 0, 2**60 + 1),
        (None, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, READINGS_DDL).coalesce(1)
    got = {(r.pump_id, r.value, r.pos) for r in latest_of_batches(df).collect()}
    assert got == {("p", 3.0, 2**60 + 1), (None, None, None)}


def test_latest_from_files_equals_batch(spark):
    """A stream of payload files gives what the batch reader gives, over restarts."""
    root = work_path(spark, "test-files")
    src, sink, ck = f"{root}/landing", f"{root}/sink", f"{root}/ck"

    def put(pump, name, body, signal="status", detailed="false"):
        folder = pathlib.Path(src) / f"pump_id={pump}" / f"signal={signal}" / f"detailed={detailed}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(body)

    def item(t, v):
        return f'{{"time": "{t}", "value": {v}, "validity": 0}}'

    def run():
        files = monitors.landed_files_stream(spark, src)
        monitors.start_latest_monitor(files, sink, ck, {"availableNow": True}).awaitTermination()

    put("007", "a.json", f"[{item('2024-01-01T00:00:00Z', 1)}, {item('2024-01-02T00:00:00Z', 2)}]".encode())
    put("7", "a.json", b"\xef\xbb\xbf[" + item("2024-01-01T00:00:00Z", 3).encode() + b"]", "speed", "true")
    put("8", "empty.json", b"")
    put("9", "broken.json", b"[{")
    run()
    put("007", "b.json", f"[{item('2024-01-01T12:00:00Z', 5)}]".encode())
    put("8", "b.json", f"[{item('2024-01-03T00:00:00Z', 6)}]".encode())
    run()
    landed = read_landed_files(spark, src, "pump_id", "signal")
    want = as_set(latest_per_signal(readings_from_landed(landed)).select("pump_id", "signal", "value", "time"))
    assert as_set(monitors.read_latest(spark, sink)) == want
    assert {(p, v) for p, _, v, _ in want} == {("007", 2.0), ("7", 3.0), ("8", 6.0)}


def put_payload(src, pump, name, value, day=1):
    folder = pathlib.Path(src) / f"pump_id={pump}" / "signal=status" / "detailed=false"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(f'[{{"time": "2024-01-{day:02d}T00:00:00Z", "value": {value}, "validity": 0}}]')


def test_files_take_one_batch_and_few_parts_whatever_their_number(spark):
    """10,050 files are one batch (not one per 10,000), over bounded parts of state."""
    root = work_path(spark, "test-many-files")
    src, sink, ck = f"{root}/landing", f"{root}/sink", f"{root}/ck"
    for pump in range(50):
        for n in range(201):
            put_payload(src, pump, f"{n}.json", n, 1 + n % 28)
    tasks = named_files.listing_tasks(spark)
    with setting(spark, "spark.sql.shuffle.partitions", tasks + 8):
        q = monitors.start_latest_monitor(monitors.landed_files_stream(spark, src), sink, ck, {"availableNow": True})
        q.awaitTermination()
        got = {(r.pump_id, r.value, r.time) for r in monitors.read_latest(spark, sink).collect()}
    assert len([p for p in q.recentProgress if p["numInputRows"]]) == 1
    for operator in (0, 1):
        assert len([d for d in (pathlib.Path(ck) / "state" / str(operator)).iterdir() if d.name.isdigit()]) == tasks
    assert {(p, t) for p, _, t in got} == {(str(p), dt.datetime(2024, 1, 28)) for p in range(50)}
    assert {v for _, v, _ in got} <= set(range(27, 201, 28))


def test_new_files_come_once(spark):
    """Each file once over triggers and starts; hidden names and empty folders give none."""
    root = work_path(spark, "test-new-files")
    src, out, ck = f"{root}/landing", f"{root}/out", f"{root}/ck"
    pathlib.Path(f"{src}/pump_id=5/empty").mkdir(parents=True)
    for pump in range(3):
        put_payload(src, pump, "a.json", pump)
    put_payload(src, 0, ".x.part", 9)
    put_payload(src, "7/_temporary", "b.json", 9)
    (pathlib.Path(src) / "_SUCCESS").write_text("{}")
    (pathlib.Path(src) / "top.json").write_text("[]")
    files = named_files.stream_new_files(spark, src)

    def run():
        def write(batch, n):
            batch.withColumn("n", F.lit(n)).write.mode("append").parquet(out)

        files.writeStream.foreachBatch(write).option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination()
        return sorted((r.n, r.file) for r in spark.read.parquet(out).collect())

    below = "signal=status/detailed=false"
    first = [(0, f"pump_id={p}/{below}/a.json") for p in range(3)] + [(0, "top.json")]
    assert run() == first
    put_payload(src, 0, "a.json", 5)  # written over: known
    put_payload(src, 0, "c.json", 5)
    assert run() == [*first, (1, f"pump_id=0/{below}/c.json")]
    row = spark.read.parquet(out).where("n = 1").first()
    there = pathlib.Path(src) / row.file
    assert (row.length, row.modified) == (there.stat().st_size, there.stat().st_mtime_ns // 1_000_000)
    assert run() == [*first, (1, f"pump_id=0/{below}/c.json")]


def test_listing_that_runs_again_gives_the_same(tmp):
    """A file that lands between two runs of a task waits for the next trigger."""
    import pyarrow as pa

    schema = pa.schema([("file", pa.string())])
    names = ["a"]
    listed = lambda: iter([pa.RecordBatch.from_arrays([pa.array(names)], schema=schema)])
    run = lambda trigger: [f for b in named_files._kept(f"{tmp}/kept", trigger, schema, listed) for f in b.column("file").to_pylist()]
    assert run("0") == ["a"]
    names.append("b")
    assert run("0") == ["a"]
    assert run("1") == ["a", "b"]
    assert [p.name for p in pathlib.Path(f"{tmp}/kept").iterdir()] == ["1"]
    empty = list(named_files._kept(f"{tmp}/none", "0", schema, lambda: iter(())))
    assert empty == [] and [p.name for p in pathlib.Path(f"{tmp}/none").iterdir()] == ["0"]


def test_limited_files_are_taken_by_the_file_source(spark):
    """With a limit a trigger takes so many files, as Spark's file source does."""
    root = work_path(spark, "test-limited-files")
    src, sink, ck = f"{root}/landing", f"{root}/sink", f"{root}/ck"
    for pump in range(3):
        put_payload(src, pump, "a.json", pump)
    files = monitors.landed_files_stream(spark, src, files_per_trigger=2)
    q = monitors.start_latest_monitor(files, sink, ck, {"availableNow": True})
    q.awaitTermination()
    assert [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]] == [2, 1]
    assert {(r.pump_id, r.value) for r in monitors.read_latest(spark, sink).collect()} == {("0", 0.0), ("1", 1.0), ("2", 2.0)}


def test_labels_of_files_stop_when_idle(spark):
    """A clock drives the listing; its rows do not keep a stream from being idle."""
    root = work_path(spark, "test-idle-files")
    src, sink, ck = f"{root}/landing", f"{root}/sink", f"{root}/ck"
    put_payload(src, 1, "a.json", 4)
    files = monitors.landed_files_stream(spark, src)
    monitors.stop_when_idle(monitors.start_label_monitor(files, sink, ck, {"processingTime": "4 seconds"}, 86400.0), 90)
    assert [(r.pump_id, r.label) for r in monitors.read_labels(spark, sink).collect()] == [("1", "4.0")]
