import datetime as dt
import json
import os

from pyspark.sql import functions as F

from sigfleet.sources.result_docs import read_result_docs

PID = "00000000-0000-0000-0000-000000000031"


def saw_series(n=20):
    """``n`` invented readings, 7 minutes apart: 0, 1, 2, 0, 1, 2, ..."""
    t0 = dt.datetime(2031, 2, 3, 4, 5, 6)
    return [
        {"time": (t0 + dt.timedelta(minutes=7 * i)).strftime("%Y-%m-%dT%H:%M:%SZ"), "value": float(i % 3), "validity": 4}
        for i in range(n)
    ]


def doc(endpoint, datos, name="north 1"):
    return {
        "bomba": {"id": PID, "name": name},
        "endpoint": endpoint,
        "rango": {"inicio": "2031-02-03T00:00:00.5", "fin": "2031-02-04T00:00:00"},
        "datos": datos,
        "timestamp_consulta": "2031-02-04T00:00:09.250000",
    }


def write(path, obj):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(obj, f, indent=2, ensure_ascii=False)


def test_single_signal_document(spark, tmp):
    write(f"{tmp}/docs/a.json", doc("onoffschedule", [*saw_series(), 5, None, "x"]))
    r = read_result_docs(spark, f"{tmp}/docs")
    assert r.count() == 20  # elements that are no reading cost only themselves
    assert r.where("value = 1.0").count() == 7
    first, last = r.agg(F.min("time"), F.max("time")).first()
    assert first == dt.datetime(2031, 2, 3, 4, 5, 6) and last == first + dt.timedelta(minutes=7 * 19)
    assert {x.signal for x in r.select("signal").distinct().collect()} == {"onoffschedule"}


def test_bundle_and_empty_documents(spark, tmp):
    write(f"{tmp}/docs/b.json", doc("all_basic", {"status": [], "power": [], "speed": []}, "north 2"))
    write(f"{tmp}/docs/c.json", doc("status", [], "north 2"))
    series = saw_series(3)
    write(f"{tmp}/docs/d.json", doc("all_detailed", {"detailed_status": series, "detailed_power": [], "detailed_speed": series[:1]}))
    r = read_result_docs(spark, f"{tmp}/docs")
    rows = r.collect()
    assert len(rows) == 4
    assert {(x.signal, x.detailed) for x in rows} == {("status", True), ("speed", True)}


def test_json_lines_layout(spark, tmp):
    os.makedirs(f"{tmp}/jl")
    with open(f"{tmp}/jl/part.json", "w") as f:
        for d in (doc("power", saw_series(5)), doc("all_basic", {"status": saw_series(2), "power": [], "speed": []})):
            f.write(json.dumps(d) + "\n")
    r = read_result_docs(spark, f"{tmp}/jl", multi_line=False)
    assert sorted((x.signal, x.n) for x in r.groupBy("signal").agg(F.count("*").alias("n")).collect()) == [
        ("rawpower", 5),
        ("status", 2),
    ]
