import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from sigfleet.sinks import bom, writers
from sigfleet.sources.result_docs import read_result_docs
from tests.test_operators import ROWS, pm

NOW = dt.datetime(2024, 1, 30, 0, 0, 0)
START = dt.datetime(2024, 1, 1)
END = dt.datetime(2024, 1, 2)


def test_single_result_documents_round_trip(spark, tmp, mk_readings, mk_pumps):
    docs = writers.result_documents(mk_readings(ROWS), pm(mk_pumps), "status", START, END, NOW)
    got = {d.bomba.id: d for d in docs.orderBy(F.desc("parte")).collect()}
    assert got["a"].file_key == "consulta_status_north1_u1_20240130_000000"
    assert got["c"].file_key == "consulta_status_Sin_nombre_20240130_000000"
    parts = docs.where("bomba.id = 'a'").orderBy("parte").collect()
    assert [x.time for d in parts for x in d.datos] == ["2024-01-01T00:00:00Z", "2024-01-01T00:30:00Z", "2024-01-01T01:00:00Z"]
    assert got["d"].datos == []
    writers.write_documents(docs, f"{tmp}/docs")
    back = read_result_docs(spark, f"{tmp}/docs", multi_line=False)
    assert back.count() == 4  # 3 for pump a, 1 for pump b
    assert {r.signal for r in back.collect()} == {"status"}


def test_bundle_result_documents(spark, tmp, mk_readings, mk_pumps):
    docs = writers.result_documents(mk_readings(ROWS), pm(mk_pumps), "all_basic", START, END, NOW)
    a = docs.where("bomba.id = 'a'").collect()
    assert all(set(d.datos) == {"status", "power", "speed"} for d in a)
    assert [sum(len(d.datos[k]) for d in a) for k in ("status", "power", "speed")] == [3, 2, 0]
    assert writers.result_documents(mk_readings(ROWS), pm(mk_pumps), "detailed_status", START, END, NOW).where(
        "size(datos) > 0"
    ).count() == 0
    writers.write_documents(docs, f"{tmp}/docs")
    back = read_result_docs(spark, f"{tmp}/docs", multi_line=False)
    assert {(r.signal, r.n) for r in back.groupBy("signal").count().withColumnRenamed("count", "n").collect()} == {
        ("status", 4), ("rawpower", 2)
    }


def test_output_knobs(spark, tmp, mk_pumps):
    p = pm(mk_pumps)
    writers.write_output(p, f"{tmp}/csv", fmt="csv", separate_files=True, now=NOW)
    assert len(glob.glob(f"{tmp}/csv/pump_id=*")) == 4
    back = spark.read.option("header", True).csv(f"{tmp}/csv")
    assert "fetched_at" in back.columns and back.count() == 4
    writers.write_output(p, f"{tmp}/json", include_timestamp=False)
    assert "fetched_at" not in spark.read.json(f"{tmp}/json").columns
    with pytest.raises(ValueError):
        writers.write_output(p, f"{tmp}/x", fmt="excel")


def test_latest_csv_export(spark, tmp, mk_readings, mk_pumps):
    from sigfleet.operators.latest import latest_wide

    exp = writers.latest_export(latest_wide(pm(mk_pumps), mk_readings(ROWS)), NOW)
    writers.write_csv(exp, f"{tmp}/latest")
    back = spark.read.option("header", True).csv(f"{tmp}/latest")
    assert back.columns[:5] == ["ID", "Nombre", "Timestamp", "Estado_Disponible", "Potencia_Disponible"]
    assert back.count() == 4


def test_csv_keeps_blanks_quotes_and_fractions(spark, tmp):
    df = spark.sql("select ' a, \"b\" ' as name, timestamp_ntz '2024-01-01 00:00:00.250125' as t")
    writers.write_csv(df, f"{tmp}/c")
    lines = open(glob.glob(f"{tmp}/c/part-*.csv")[0]).read().splitlines()
    assert lines == ["name,t", '" a, ""b"" ",2024-01-01T00:00:00.250125']


def test_documents_keep_fractions(spark, tmp, mk_readings, mk_pumps):
    r = mk_readings([("a", "status", "2024-01-01 00:00:00.250000", 1.0, 0), ("a", "status", "2024-01-01 00:00:01", 1.0, 1)])
    docs = writers.result_documents(r, pm(mk_pumps), "status", START, END, NOW).where("bomba.id = 'a'").collect()
    assert [x.time for d in docs for x in d.datos] == ["2024-01-01T00:00:00.250000Z", "2024-01-01T00:00:01Z"]


def test_report_documents(spark, tmp, mk_readings, mk_pumps):
    from sigfleet.operators.reports import fleet_summary, report_rows

    rows = report_rows(pm(mk_pumps), mk_readings(ROWS))
    writers.report_documents(fleet_summary(rows), rows, f"{tmp}/report", NOW)
    s = spark.read.json(f"{tmp}/report/summary").first()
    assert (s.total_bombas, s.bombas_procesadas, s.bombas_con_fallos) == (4, 3, 1)
    assert spark.read.json(f"{tmp}/report/resumen_por_bomba").count() == 4


def test_bom_repair(spark, tmp):
    src = f"{tmp}/in"
    os.makedirs(src)
    with open(f"{src}/a.json", "wb") as f:
        f.write(b"\xef\xbb\xbf[1, 2]")
    with open(f"{src}/b.json", "wb") as f:
        f.write(b"[3]")
    with open(f"{src}/notes.txt", "wb") as f:
        f.write(b"\xef\xbb\xbfhello")
    os.makedirs(f"{src}/sub")
    with open(f"{src}/sub/a.json", "wb") as f:
        f.write(b"[4]\n")
    status = {r.file: r for r in bom.repair_bom(spark, src, f"{tmp}/out").collect()}
    assert status["a.json"].status == "repaired" and status["a.json"].bytes_out == 6
    assert status["b.json"].status == "clean"
    assert status["notes.txt"].status == "skipped"
    assert status["sub/a.json"].status == "clean"
    # Every file at its own path, byte for byte but for the mark.
    assert open(f"{tmp}/out/sub/a.json", "rb").read() == b"[4]\n"
    assert open(f"{tmp}/out/a.json", "rb").read() == b"[1, 2]"
    assert not os.path.exists(f"{tmp}/out/notes.txt")
    # input untouched
    assert open(f"{src}/a.json", "rb").read().startswith(b"\xef\xbb\xbf")


def test_default_export_path():
    assert writers.default_export_path("/data/out/", NOW) == "/data/out/fleet_data_20240130_000000"
