import datetime as dt
import glob
import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from sigfleet.operators import latest, scans
from sigfleet.sources import driver_tables as dtab
from sigfleet.sources.readings_table import merge_readings, scan_readings, write_readings
from tests.conftest import SF_CHECK, SF_SMOKE
from tests.test_plans import plan

S, E = dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 20)


def test_table_round_trip_and_pruning(spark, tmp):
    path = f"{tmp}/readings"
    write_readings(dtab.readings(spark, SF_CHECK), path, files=4)
    assert glob.glob(f"{path}/signal=rawpower/day=2024-01-15/*.parquet")

    via_table = scan_readings(spark, path, signals=["rawpower"], pump_ids=[7], start=S, end=E)
    via_events = dtab.readings(spark, SF_CHECK, signals=["rawpower"], pump_ids=[7], start=S, end=E)
    cols = ["pump_id", "signal", "time", "value", "pos"]
    assert sorted(via_table.select(*cols).collect()) == sorted(via_events.select(*cols).collect())

    p = plan(via_table)
    part = [line for line in p.splitlines() if "PartitionFilters" in line][0]
    assert "signal" in part and "day" in part
    pushed = [line for line in p.splitlines() if "PushedFilters" in line][0]
    assert "pump_id" in pushed and "time" in pushed


def test_files_are_sorted_by_pump_and_time(spark, tmp):
    path = f"{tmp}/readings"
    write_readings(dtab.readings(spark, SF_CHECK), path, files=4)
    files = glob.glob(f"{path}/signal=*/day=*/*.parquet")
    assert files
    for f in files[::10]:
        t = pq.read_table(f, partitioning=None).select(["pump_id", "time", "pos"]).to_pylist()
        order = [(x["pump_id"], x["time"], x["pos"]) for x in t]
        assert order == sorted(order)


def test_merge_is_repeat_safe_and_touches_only_its_days(spark, tmp):
    path = f"{tmp}/readings"
    r = dtab.readings(spark, SF_SMOKE)
    merge_readings(scans.time_range(r, None, E), path, files=2)
    kept = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/signal=*/day=2024-01-05/*.parquet")}
    late = scans.time_range(r, dt.datetime(2024, 1, 15), None).withColumn("pos", F.col("pos") + 1000)
    merge_readings(late, path, files=2)
    merge_readings(late, path, files=2)
    key = ["pump_id", "signal", "detailed", "time", "value"]
    t = spark.read.parquet(path)
    assert sorted(t.select(*key).collect()) == sorted(r.select(*key).collect())
    assert kept == {f: os.path.getmtime(f) for f in glob.glob(f"{path}/signal=*/day=2024-01-05/*.parquet")}


def test_operators_agree_on_table_and_driver_source(spark, tmp):
    path = f"{tmp}/readings"
    write_readings(dtab.readings(spark, SF_CHECK), path, files=3)
    t = scan_readings(spark, path)
    e = dtab.readings(spark, SF_CHECK)
    a = latest.latest_per_signal(t).collect()
    b = latest.latest_per_signal(e).collect()
    assert sorted(a) == sorted(b)
    # day predicate is added by time_range when the table has a day column
    r = scans.range_scan(t, pump_ids=[7], start=S, end=E)
    assert "day" in [line for line in plan(r).splitlines() if "PartitionFilters" in line][0]
