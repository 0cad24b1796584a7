import datetime as dt

from sigfleet.schemas import LANDED_SCHEMA
from sigfleet.sources.payloads import fetch_outcomes, payload_elements, readings_from_landed

BOM = b"\xef\xbb\xbf"
ONE = b'[{"time": "2031-02-03T04:05:06Z", "value": 7.5, "validity": 3}]'
FETCHED = dt.datetime(2031, 2, 4)

# (case, body, http_status, error, expected outcome)
CASES = [
    ("array", ONE, 200, None, "ok"),
    ("array_bom", BOM + ONE, 200, None, "ok"),
    ("zero_bytes", b"", 200, None, "empty"),
    ("blanks", b"  \n\t ", 200, None, "empty"),
    ("bom_only", BOM, 200, None, "empty"),
    ("empty_array", b"[]", 200, None, "empty"),
    ("not_json", b"not json", 200, None, "malformed"),
    ("truncated", b'[{"time": "2031-02-03T04:05:06Z", "val', 200, None, "malformed"),
    ("trailing_text", ONE + b" x", 200, None, "malformed"),
    ("object_trailing_text", b'{"a": 1} x', 200, None, "malformed"),
    ("two_arrays", b"[1] [2]", 200, None, "malformed"),
    ("two_arrays_comma", b"[1],[2]", 200, None, "malformed"),
    ("extra_bracket", b"[1]]", 200, None, "malformed"),
    ("two_objects", b'{"a": 1}{"b": 2}', 200, None, "malformed"),
    ("two_objects_comma", b'{"a": 1},{"b": 2}', 200, None, "malformed"),
    ("extra_brace", b'{"a": 1}}', 200, None, "malformed"),
    ("member", b'[1],"x":[2]', 200, None, "malformed"),
    ("closes_and_opens", b'[1]} {"y":[2]', 200, None, "malformed"),
    ("single_quotes", b"['a']", 200, None, "malformed"),
    ("scalar", b"42", 200, None, "malformed"),
    ("json_null", b"null", 200, None, "malformed"),
    ("empty_object", b"{}", 200, None, "object"),
    ("object", b'{"a": 1}', 200, None, "object"),
    ("bad_utf8", b"\xff\xfe[1]", 200, None, "error"),
    ("http_500", ONE, 500, None, "error"),
    ("transport", None, None, "timeout", "error"),
    ("no_pump", None, None, "no_pump", "no_pump"),
    ("no_signal", None, None, "no_signal", "no_signal"),
]


def landed(spark):
    rows = [(c, "status", False, FETCHED, st, err, body) for c, body, st, err, _ in CASES]
    return spark.createDataFrame(rows, LANDED_SCHEMA)


def test_outcome_per_class(spark):
    got = {r["pump_id"]: r["outcome"] for r in fetch_outcomes(landed(spark)).collect()}
    assert got == {c: exp for c, _, _, _, exp in CASES}


def test_old_booleans_kept_apart(spark):
    got = {r["pump_id"]: r for r in fetch_outcomes(landed(spark)).collect()}
    assert got["array"]["is_nonempty"] and got["array"]["is_not_null"] and got["array"]["is_not_empty_object"]
    assert not got["empty_array"]["is_nonempty"] and got["empty_array"]["is_not_empty_object"]
    assert not got["empty_object"]["is_not_empty_object"]
    assert not got["json_null"]["is_not_null"]
    assert got["http_500"]["is_not_null"]  # a failed fetch looked like "available"


def test_readings_only_from_ok_bodies(spark):
    rows = readings_from_landed(landed(spark)).collect()
    assert sorted(r["pump_id"] for r in rows) == ["array", "array_bom"]
    r = rows[0]
    assert r["time"] == dt.datetime(2031, 2, 3, 4, 5, 6)
    assert r["value"] == 7.5 and r["validity"] == 3 and r["pos"] == 0


def test_bad_elements_cost_only_themselves(spark):
    body = b"[" + ONE[1:-1] + b', 5, null, "x", [1], ' + ONE[1:-1] + b"]"
    df = spark.createDataFrame([("p", "status", True, FETCHED, 200, None, body)], LANDED_SCHEMA)
    assert [(r.pos, r.detailed, r.value) for r in readings_from_landed(df).collect()] == [(0, True, 7.5), (5, True, 7.5)]
    (r,) = payload_elements(df).collect()
    assert (r.elements, r.rejected) == (6, 4)


def test_object_body_never_a_row_of_nulls(spark):
    rows = readings_from_landed(landed(spark)).where("pump_id in ('object', 'empty_object')").collect()
    assert rows == []


def test_landed_files_with_partitioned_layout(spark, tmp):
    import os

    from sigfleet.sources.payloads import read_landed_files

    for pump, sig, body in [("p1", "status", ONE), ("p1", "rawpower", BOM + ONE), ("p2", "status", b""), ("007", "status", ONE)]:
        d = f"{tmp}/landed/pump_id={pump}/signal={sig}"
        os.makedirs(d)
        with open(f"{d}/body.json", "wb") as f:
            f.write(body)
    landed = read_landed_files(spark, f"{tmp}/landed", pump_id="pump_id", signal="signal")
    got = {(r.pump_id, r.signal): r.outcome for r in fetch_outcomes(landed).collect()}
    assert got == {("p1", "status"): "ok", ("p1", "rawpower"): "ok", ("p2", "status"): "empty", ("007", "status"): "ok"}
    assert readings_from_landed(landed).count() == 3


def test_landed_folders_carry_series_and_transport(spark, tmp):
    import os

    from sigfleet.sources.payloads import read_landed_files

    cases = [("p1", "true", "200", "none", ONE), ("p2", "false", "503", "none", b"x"), ("p3", "false", "200", "no_pump", b"x")]
    for pump, det, code, err, body in cases:
        d = f"{tmp}/landed/pump_id={pump}/signal=status/detailed={det}/http_status={code}"
        if err != "none":
            d += f"/error={err}"
        else:
            d += "/error=__HIVE_DEFAULT_PARTITION__"
        os.makedirs(d)
        with open(f"{d}/body.json", "wb") as f:
            f.write(body)
    landed = read_landed_files(spark, f"{tmp}/landed", pump_id="pump_id", signal="signal")
    got = {r.pump_id: (r.detailed, r.outcome) for r in fetch_outcomes(landed).collect()}
    assert got == {"p1": (True, "ok"), "p2": (False, "error"), "p3": (False, "no_pump")}
