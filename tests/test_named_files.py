"""Files with exact bytes and names of their own (K8, K1, K6, K7)."""

import datetime as dt
import json
import os

import pytest

from sigfleet.sinks import bom, named_files, writers
from sigfleet.sinks.named_files import checked_path, read_named_files, write_named_files

NOW = dt.datetime(2024, 1, 30)
BOM = b"\xef\xbb\xbf"


def tree(root):
    out = {}
    for d, _, names in os.walk(root):
        for n in names:
            if not n.endswith(".crc"):
                out[os.path.relpath(f"{d}/{n}", root)] = open(f"{d}/{n}", "rb").read()
    return out


def test_bytes_and_paths_survive(spark, tmp):
    files = {
        "a.bin": bytes(range(256)), "in/a.bin": b"", "in/deep/in/a.bin": b"\r\n\xff", "ü b/%20.txt": b"x" * 100_000,
    }
    rows = [(f, bytearray(c), 1) for f, c in files.items()] + [("null", None, 1)]
    df = spark.createDataFrame(rows, "file string, content binary, path int").repartition(3)
    write_named_files(df, f"{tmp}/out")
    got = tree(f"{tmp}/out")
    assert json.loads(got.pop("_SUCCESS")) == {"files": 5, "bytes": sum(map(len, files.values()))}
    assert got == files | {"null": b""}
    back = {r.file: bytes(r.content) for r in read_named_files(spark, f"file://{tmp}/out").collect()}
    assert back == got
    write_named_files(df, f"{tmp}/out")  # again: the same files
    assert len(tree(f"{tmp}/out")) == 6


def test_bad_and_repeated_paths_fail(spark, tmp):
    for bad in (None, "", "/etc/x", "../x", "a/../b", "a//b", "."):
        with pytest.raises(ValueError):
            checked_path(bad)
    two = spark.createDataFrame([("a", bytearray(b"1")), ("a", bytearray(b"2"))], "file string, content binary")
    with pytest.raises(ValueError, match="several rows"):
        write_named_files(two, f"{tmp}/two")
    out = spark.createDataFrame([("../a", bytearray(b"1"))], "file string, content binary")
    with pytest.raises(Exception, match="below the folder"):
        write_named_files(out, f"{tmp}/x/y")
    assert not os.path.exists(f"{tmp}/x/a") and not os.path.exists(f"{tmp}/x/y/_SUCCESS")
    write_named_files(two.limit(0), f"{tmp}/none")
    assert set(tree(f"{tmp}/none")) == {"_SUCCESS"}


def test_a_failed_write_leaves_no_part(tmp, monkeypatch):
    class Broken(named_files.NamedFilesWriter):
        pass

    def rows():
        yield {"file": "a", "content": b"1"}
        raise OSError("lost")

    with pytest.raises(OSError):
        Broken(tmp).write(rows())
    assert tree(tmp) == {"a": b"1"}


def test_repair_keeps_folders_apart_and_bytes(spark, tmp):
    src = f"{tmp}/x/in"
    files = {
        "x.json": BOM + b"[1]", "a/in/x.json": b"[2]\n", "in/x.json": b"[3]\r\n\r\n", "bad.json": BOM + b"\xff\xfe[",
        "empty.json": b"", "mark.json": BOM, "other.txt": BOM + b"t",
    }
    for f, c in files.items():
        os.makedirs(os.path.dirname(f"{src}/{f}"), exist_ok=True)
        open(f"{src}/{f}", "wb").write(c)
    status = {r.file: r for r in bom.repair_bom(spark, src, f"{tmp}/out").collect()}
    got = tree(f"{tmp}/out")
    got.pop("_SUCCESS")
    assert got == {f: c.removeprefix(BOM) for f, c in files.items() if f.endswith(".json")}
    assert {f: r.status for f, r in status.items()} == {
        f: "skipped" if f.endswith(".txt") else "repaired" if c.startswith(BOM) else "clean" for f, c in files.items()
    }
    assert all(r.bytes_out == len(got[f]) for f, r in status.items() if r.status != "skipped")
    assert tree(src) == files


def test_document_files_are_named_and_whole(spark, tmp, mk_readings, mk_pumps):
    pumps = mk_pumps([("a", "EB1 G1"), ("b", None), ("c", None), ("d/e", "x/y")])
    r = mk_readings([
        ("a", "status", "2024-01-10 10:00:00", 1.0, 0), ("a", "status", "2024-01-10 12:30:00", 2.0, 1),
        ("d/e", "status", "2024-01-10 10:00:00", 3.0, 0),
    ])
    docs = writers.result_documents(r, pumps, "status", dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 11), NOW)
    writers.write_document_files(docs, f"{tmp}/docs")
    got = tree(f"{tmp}/docs")
    got.pop("_SUCCESS")
    stem = "consulta_status_{}_20240130_000000"
    assert set(got) == {
        "a/" + stem.format("EB1_G1") + "_2024011010.json", "a/" + stem.format("EB1_G1") + "_2024011012.json",
        "b/" + stem.format("Sin_nombre") + ".json", "c/" + stem.format("Sin_nombre") + ".json",
        "d%2Fe/" + stem.format("x%2Fy") + "_2024011010.json",
    }
    one = json.loads(got["a/" + stem.format("EB1_G1") + "_2024011012.json"])
    assert [x["value"] for x in one["datos"]] == [2.0] and one["bomba"]["id"] == "a"
    back = spark.read.option("recursiveFileLookup", "true").json(f"{tmp}/docs", pathGlobFilter="*.json")
    assert back.count() == 5


def test_small_files_are_dealt_and_listed_by_tasks(spark, tmp, monkeypatch):
    """Neither few bytes nor many folders put all files into one task or the driver."""
    from sigfleet.sources import payloads

    def on_the_driver(*_):
        raise AssertionError("files listed one by one on the driver")

    monkeypatch.setattr(payloads, "_zero_length_files", on_the_driver)
    rows = [(f"{i % 40}/{i % 7}/{i}", bytearray(str(i).encode()) if i % 10 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "file string, content binary").coalesce(1)
    write_named_files(df, f"{tmp}/out")
    back = read_named_files(spark, f"{tmp}/out")
    assert back.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert {r.file: bytes(r.content) for r in back.collect()} == {f: bytes(c or b"") for f, c in rows}


def test_hidden_files_are_left_out_as_by_spark(spark, tmp):
    files = {
        "a/x": b"1", "_b/x": b"2", "_b=1/x": b"3", ".c/x": b"4", "_x": b"5", "_x=1": b"6", ".x": b"7", "y._COPYING_": b"8",
        "empty": b"", "_b/empty": b"", "_empty=1": b"", ".empty": b"",
    }
    for f, c in files.items():
        os.makedirs(os.path.dirname(f"{tmp}/in/{f}"), exist_ok=True)
        open(f"{tmp}/in/{f}", "wb").write(c)
    by_spark = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{tmp}/in")
    full = {os.path.relpath(r.path.removeprefix("file:"), f"{tmp}/in") for r in by_spark.select("path").collect()}
    assert {r.file for r in read_named_files(spark, f"{tmp}/in").collect()} == full | {"empty", "_b/empty"}


def test_a_list_of_files_is_of_its_moment(spark, tmp):
    os.makedirs(f"{tmp}/in")
    open(f"{tmp}/in/a.json", "wb").write(BOM + b"[]")
    status = bom.repair_bom(spark, f"{tmp}/in", f"{tmp}/in/out")
    assert [(r.file, r.status, r.bytes_out) for r in status.collect()] == [("a.json", "repaired", 2)]
    with pytest.raises(Exception):
        read_named_files(spark, f"{tmp}/none").collect()


def test_top_levels_stop_where_folders_are_enough(tmp):
    for f in ("a/1/x", "a/2/x", "b/1/x", "b/2/y/x", "c"):
        os.makedirs(os.path.dirname(f"{tmp}/{f}"), exist_ok=True)
        open(f"{tmp}/{f}", "wb").write(b"1")
    assert {x[0] for x in named_files._top(tmp, 2)} == {"a", "b", "c"}
    assert {x[0] for x in named_files._top(tmp, 3)} == {"a/1", "a/2", "b/1", "b/2", "c"}
    assert {x[0] for x in named_files._top(tmp, 9)} == {"a/1/x", "a/2/x", "b/1/x", "b/2/y/x", "c"}


def test_large_contents_come_in_small_batches():
    import pyarrow as pa

    class Rows(named_files.NamedFilesArrowWriter):
        pass

    seen = []

    def batches():
        for n in range(3):
            seen.append(n)
            yield pa.RecordBatch.from_arrays([pa.array([f"../{n}"]), pa.array([b"x"])], ["file", "content"])

    with pytest.raises(ValueError, match="below the folder"):
        Rows("/nowhere").write(batches())
    assert seen == [0]  # a batch at a time


def test_batches_of_a_write_are_bounded(spark, tmp, monkeypatch):
    monkeypatch.setattr(named_files, "WRITE_ROWS", 3)
    monkeypatch.setattr(named_files.NamedFilesArrowWriter, "write", _sizes)
    df = spark.range(50).selectExpr("concat('f', id) as file", "cast('x' as binary) as content")
    before = spark.conf.get(named_files.BATCH_ROWS, None)
    write_named_files(df, f"{tmp}/out", unique=True)
    assert json.loads(tree(f"{tmp}/out")["_SUCCESS"]) == {"files": 50, "bytes": 0}
    assert spark.conf.get(named_files.BATCH_ROWS, None) == before


def _sizes(self, iterator):
    rows = [b.num_rows for b in iterator]
    assert max(rows, default=0) <= 3
    return named_files.Written(sum(rows), 0)


def test_batches_of_large_contents_are_bounded_by_bytes(spark, tmp, monkeypatch):
    """Memory of a worker does not grow with the rows that its task writes."""
    monkeypatch.setattr(named_files.NamedFilesArrowWriter, "write", _bytes)
    df = spark.range(50).selectExpr("concat('f', id) as file", "cast(repeat('x', 1000000) as binary) as content")
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    write_named_files(df, f"{tmp}/out", unique=True)
    assert json.loads(tree(f"{tmp}/out")["_SUCCESS"]) == {"files": 50, "bytes": 50_000_000}
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before


def _bytes(self, iterator):
    rows = size = 0
    for b in iterator:
        assert b.nbytes <= (4 << 20) + 1_100_000  # and one content
        rows, size = rows + b.num_rows, size + sum(len(c.as_py()) for c in b.column("content"))
    return named_files.Written(rows, size)
