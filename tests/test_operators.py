import datetime as dt

from pyspark.sql import functions as F

from sigfleet.operators import bundles, catalog_ops, latest, reports, samples, scans
from tests.conftest import T

ROWS = [
    # pump, signal, time, value, pos
    ("a", "status", "2024-01-01 00:00:00", 1.0, 0),
    ("a", "status", "2024-01-01 00:30:00", 0.0, 1),
    ("a", "status", "2024-01-01 01:00:00", 1.0, 2),
    ("a", "rawpower", "2024-01-01 00:10:00", 10.0, 0),
    ("a", "rawpower", "2024-01-01 00:10:00", 12.0, 1),  # same time: pos decides
    ("a", "fault", "2024-01-02 00:00:00", 3.0, 0),
    ("a", "inservice", "2024-01-01 00:00:00", 1.0, 0),
    ("a", "inservice", "2024-01-03 00:00:00", 0.0, 1),  # latest: off
    ("b", "status", "2024-01-01 00:00:00", 5.0, 0),
    ("b", "inservice", "2024-01-03 00:00:00", 1.0, 0),
    ("c", "speed", "2024-01-05 00:00:00", 7.0, 0),
]


def rd(mk_readings):
    return mk_readings(ROWS)


def pm(mk_pumps):
    return mk_pumps([("a", "north1 u1"), ("b", "north10 u1"), ("c", None), ("d", "south2 u2")])


def test_range_scan_inclusive_and_open(mk_readings):
    r = rd(mk_readings)
    got = scans.range_scan(r, ["a"], ["status"], "2024-01-01T00:00:00", "2024-01-01T00:30:00")
    assert sorted(x.pos for x in got.collect()) == [0, 1]
    assert scans.range_scan(r, ["a"], ["status"], None, "2024-01-01T00:30:00").count() == 2
    assert scans.range_scan(r, ["a"], ["status"], "2024-01-01T00:30:00", None).count() == 2
    assert scans.range_scan(r, ["a"], ["status"]).count() == 3
    # start after end: empty, not an error
    assert scans.range_scan(r, ["a"], None, "2024-02-01", "2024-01-01").count() == 0


def test_signal_select_by_endpoint(mk_readings):
    r = rd(mk_readings)
    assert scans.signal_select(r, "all_basic", ["a"]).count() == 5
    assert scans.signal_select(r, "power", ["a"]).count() == 2
    try:
        scans.signal_select(r, "teleport", ["a"])
        raise AssertionError("expected ValueError")
    except ValueError:
        pass


def test_carry_in(mk_readings):
    r = rd(mk_readings)
    got = scans.range_carry_in(r, T("2024-01-01 00:45:00"), T("2024-01-01 02:00:00"))
    rows = {(x.pump_id, x.signal, x.pos) for x in got.collect()}
    # status: pos1 carried in (00:30 <= 00:45), pos2 inside; rawpower carried; inservice a pos0 carried
    assert ("a", "status", 1) in rows and ("a", "status", 2) in rows and ("a", "status", 0) not in rows
    assert ("a", "rawpower", 1) in rows and ("a", "rawpower", 0) not in rows
    assert ("b", "status", 0) in rows
    assert ("c", "speed", 0) not in rows  # only after the range


def test_signal_counts_zero_fill_and_total(mk_readings):
    r = scans.range_scan(rd(mk_readings), ["a"])
    got = {x.signal: (x.points, x.label) for x in bundles.signal_counts(r, ["status", "rawpower", "speed"]).collect()}
    assert got == {
        "status": (3, "3 puntos"),
        "rawpower": (2, "2 puntos"),
        "speed": (0, "sin datos"),
        "TOTAL": (5, "5 puntos"),
    }


def test_latest_per_signal_uses_position_on_ties(mk_readings):
    got = {(x.pump_id, x.signal): x.value for x in latest.latest_per_signal(rd(mk_readings)).collect()}
    assert got[("a", "status")] == 1.0
    assert got[("a", "rawpower")] == 12.0
    assert got[("a", "inservice")] == 0.0


def test_latest_wide_keeps_pumps_without_data(mk_readings, mk_pumps):
    w = {x.pump_id: x for x in latest.latest_wide(pm(mk_pumps), rd(mk_readings)).collect()}
    assert set(w) == {"a", "b", "c", "d"}
    assert w["a"].status_value == 1.0 and w["a"].power_value == 12.0
    assert w["b"].power_value is None and w["d"].status_time is None


def test_report_rows_and_summary(mk_readings, mk_pumps):
    rows = reports.report_rows(pm(mk_pumps), rd(mk_readings))
    got = {x.pump_id: (x.has_faults, x.status_available, x.power_available, x.processed) for x in rows.collect()}
    assert got == {
        "a": (True, True, True, True),
        "b": (False, True, False, True),
        "c": (False, False, False, True),
        "d": (False, False, False, False),
    }
    s = reports.fleet_summary(rows).first()
    assert (s.total_pumps, s.processed, s.with_faults) == (4, 3, 1)


def test_exclude_offline_keeps_pumps_without_inservice(mk_readings, mk_pumps):
    kept = {x.pump_id for x in reports.exclude_offline(pm(mk_pumps), rd(mk_readings)).collect()}
    assert kept == {"b", "c", "d"}


def test_wide_record_is_whole_in_chunks(mk_readings, mk_pumps):
    rows = reports.wide_record(pm(mk_pumps), rd(mk_readings), bucket=1).orderBy("pump_id", "chunk").collect()
    assert {x.pump_id for x in rows} == {"a", "b", "c", "d"}
    a = [x for x in rows if x.pump_id == "a"]
    assert len(a) > 1 and [x.chunk for x in a] == sorted(x.chunk for x in a)
    assert [e.pos for x in a for e in x.status] == [0, 1, 2]
    assert [e.pos for x in a for e in x.power] == [0, 1] and [e.pos for x in a for e in x.faults] == [0]
    d = [x for x in rows if x.pump_id == "d"]
    assert len(d) == 1 and d[0].chunk is None and d[0].status == [] and d[0].inservice == []
    assert {len(x.status) for x in reports.wide_record(pm(mk_pumps), rd(mk_readings), detailed=True).collect()} == {0}


def test_series_chunks_cross_days_in_order(mk_readings):
    rows = [("x", "status", f"2024-01-0{d} 0{h}:30:00", float(d * 10 + h), d * 10 + h) for d in (3, 1, 2) for h in (2, 1)]
    chunks = bundles.series_chunks(mk_readings(rows), bucket=24).orderBy("chunk").collect()
    assert [[e.pos for e in c.datos] for c in chunks] == [[11, 12], [21, 22], [31, 32]]
    assert bundles.series_chunks(mk_readings(rows)).count() == 6


def test_series_sample_first_three(mk_readings):
    got = samples.series_sample(rd(mk_readings), 2).where("pump_id = 'a' and signal = 'status'")
    assert sorted(x.pos for x in got.collect()) == [0, 1]


def test_dedupe_last(spark):
    df = spark.createDataFrame([("k", 1, "x"), ("k", 3, "z"), ("k", 2, "y"), ("m", 1, "q")], "key string, o int, v string")
    got = {x.key: (x.o, x.v) for x in reports.dedupe_last(df, "key", "o", ["v"]).collect()}
    assert got == {"k": (3, "z"), "m": (1, "q")}


def test_catalog_projection_ops(mk_pumps):
    p = pm(mk_pumps)
    assert [x.pump_id for x in catalog_ops.head_n(p, 2).collect()] == ["a", "b"]
    assert catalog_ops.head_n(p).count() == 4
    ws = catalog_ops.links_workset(p)
    assert ws.count() == 64
    href = ws.where("pump_id = 'a' and signal = 'speed/detailed'").first().href
    assert href == "https://example.invalid/physicalPumps/a/speed/detailed/"
    counts = {x.links for x in catalog_ops.links_count(catalog_ops.links_map(p)).collect()}
    assert counts == {16}
    linked = catalog_ops.links_map(p)
    info = catalog_ops.pump_info(linked, ["b"]).first()
    assert info.status_href == "https://example.invalid/physicalPumps/b/status/"
    bare = linked.withColumn("links", F.map_filter("links", lambda k, v: k != "status"))
    assert catalog_ops.pump_info(bare, ["b"]).first().status_href is None


def test_fallback_per_unit(spark):
    prim = spark.createDataFrame([("p1", 1), ("p2", 2)], "name string, unit int")
    snap = spark.createDataFrame([("s1", 1), ("s2", 2)], "name string, unit int")
    out = spark.createDataFrame([(1, "ok"), (2, "error")], "unit int, outcome string")
    got = {x.name for x in catalog_ops.with_fallback(prim, snap, out, "unit").collect()}
    assert got == {"p1", "s2"}
    unknown = out.where("unit = 2").union(spark.createDataFrame([(1, None)], out.schema))
    got = {x.name for x in catalog_ops.with_fallback(prim, snap, unknown, "unit").collect()}
    assert got == {"p1", "s2"}  # no outcome, or a null one, is no error


def test_history_lookback(mk_readings):
    now = dt.datetime(2024, 1, 2, 0, 0, 0)
    detailed = rd(mk_readings).withColumn("detailed", F.lit(True))
    assert bundles.history(rd(mk_readings), now, 24).count() == 0  # plain series are not history
    h = bundles.history(detailed, now, "24")
    assert {(x.pump_id, x.signal, x.pos) for x in h.collect()} == {
        ("a", "status", 0), ("a", "status", 1), ("a", "status", 2), ("a", "rawpower", 0), ("a", "rawpower", 1),
        ("a", "fault", 0), ("b", "status", 0),
    }
    docs = bundles.history_document(detailed, now, "x").where(F.col("bomba_id") == "a").collect()
    assert {d.periodo.horas for d in docs} == {24}
    assert sum(len(d.datos.get("status", [])) for d in docs) == 3


def test_select_endpoints_mixes_plain_and_detailed(spark):
    from tests.conftest import READINGS_DDL

    rows = [
        ("a", "status", False, T("2024-01-01 00:00:00"), 1.0, 0, 0),
        ("a", "status", True, T("2024-01-01 00:00:00"), 1.0, 0, 0),
        ("a", "rawpower", True, T("2024-01-01 00:00:00"), 1.0, 0, 0),
        ("a", "fault", False, T("2024-01-01 00:00:00"), 1.0, 0, 0),
    ]
    r = spark.createDataFrame(rows, READINGS_DDL)
    got = {(x.signal, x.detailed) for x in scans.select_endpoints(r, ["status", "detailed_status", "power", "faults"]).collect()}
    assert got == {("status", False), ("status", True), ("fault", False)}


def test_outcome_report_keeps_unknown_faults_apart(spark, mk_pumps):
    import datetime as _dt

    from sigfleet.schemas import LANDED_SCHEMA
    from sigfleet.sources.payloads import fetch_outcomes

    one = b'[{"time": "2024-01-01T00:00:00Z", "value": 1.0, "validity": 0}]'
    f = _dt.datetime(2024, 1, 1)
    landed = spark.createDataFrame(
        [
            ("a", "fault", False, f, 200, None, one),
            ("a", "status", False, f, 200, None, one),
            ("b", "fault", False, f, 500, None, None),
            ("c", "fault", False, f, 200, None, b"[]"),
        ],
        LANDED_SCHEMA,
    )
    rows = reports.outcome_report_rows(pm(mk_pumps), fetch_outcomes(landed))
    got = {x.pump_id: (x.has_faults, x.faults_known, x.status_available) for x in rows.collect()}
    assert got["a"] == (True, True, True)
    assert got["b"] == (False, False, False)  # failed fetch: not "no faults"
    assert got["c"] == (False, True, False)
    assert got["d"] == (False, False, False)
