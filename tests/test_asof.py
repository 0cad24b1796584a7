import datetime as dt
import pathlib
import random
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sigfleet.operators import asof, latest, scans
from sigfleet.sources import driver_tables as dtab
from sigfleet.sources.readings_table import scan_readings, write_readings
from tests.conftest import SF_CHECK
from tests.test_plans import plan
from tests.test_properties import T0, distinct_orders, frame, readings

COLS = ["pump_id", "signal", "detailed", "time", "value", "pos"]


def rows(df):
    return sorted(tuple(r) for r in df.select(*COLS).collect())


def test_indexed_carry_in_equals_full_history(spark, tmp):
    r = dtab.readings(spark, SF_CHECK).select(*COLS)
    write_readings(dtab.readings(spark, SF_CHECK), f"{tmp}/readings", files=4)
    table = scan_readings(spark, f"{tmp}/readings").select(*COLS, "day")
    asof.write_daily_last(table.drop("day"), f"{tmp}/daily")
    index = spark.read.parquet(f"{tmp}/daily")
    for s, e in [(dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 11)), (dt.datetime(2024, 1, 17, 13, 5), dt.datetime(2024, 1, 20))]:
        want = rows(scans.range_carry_in(r, s, e))
        got = rows(asof.range_carry_in_indexed(table, index, s, e))
        assert got == want
    # the readings side reads one day for the carry-in, not the whole history
    p = plan(asof.in_force_at(table, index, dt.datetime(2024, 1, 17, 13, 5)))
    part = [line for line in p.splitlines() if "PartitionFilters" in line and "day" in line]
    assert len(part) == 2


def test_latest_from_index_equals_full_history(spark, tmp):
    r = dtab.readings(spark, SF_CHECK).select(*COLS)
    old = scans.time_range(r, None, dt.datetime(2024, 1, 20, 23, 59, 59, 999999))
    asof.write_daily_last(old, f"{tmp}/daily")
    index = spark.read.parquet(f"{tmp}/daily")
    want = rows(latest.latest_per_signal(r, fields=("value", "pos")))
    assert rows(asof.latest_from_index(r, index)) == want
    files = sum(1 for _ in pathlib.Path(f"{tmp}/daily").glob("day=*/*.parquet"))
    assert files <= 20 * asof.FILES_PER_DAY


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(readings, st.integers(0, 20))
def test_in_force_at_brute_force(spark, rs, a):
    rs = distinct_orders([x for x in rs if x[2] is not None])
    df = frame(spark, rs).select(*COLS)
    at = T0 + dt.timedelta(minutes=30 * a + 7)
    got = rows(asof.in_force_at(df, asof.daily_last(df), at))
    want = rows(scans.range_carry_in(df, at, at))
    assert got == want


POINTS = "pump_id string, signal string, detailed boolean, time timestamp_ntz, bucket int, last string"
READINGS = "pump_id string, signal string, detailed boolean, time timestamp_ntz, value double, pos long"


def brute(points, rs):
    """Per point the last reading of its series at or before its time."""
    out = []
    for p in points:
        best = None
        for r in rs:
            if None not in p[:4] and r[:3] == p[:3] and r[3] is not None and r[3] <= p[3]:
                if best is None or (r[3], r[5]) > (best[3], best[5]):
                    best = r
        out.append((*p, best[3] if best else None, best[4] if best else None))
    return sorted(out, key=repr)


def made(seed, n_points, n_readings):
    rng = random.Random(seed)
    base = dt.datetime(1969, 12, 31, 20)

    def one(i):
        pump = "hot" if rng.random() < 0.4 else f"p{rng.randrange(4)}"
        time = base + dt.timedelta(seconds=rng.choice([0.5, 1, 1800, 3600, 3600.25]) * rng.randrange(60))
        return [pump, rng.choice(["status", "speed"]), rng.random() < 0.2, time]

    points = [(*one(i), rng.randrange(3), "x") for i in range(n_points)]
    points += points[:5] + [(None, "status", False, base, 1, "x"), ("p1", "status", False, None, 1, None)]
    rs = [(*one(i), float(i), i) for i in range(n_readings)]
    rs += [("hot", "status", False, None, 9.0, n_readings), (None, "status", False, base, 9.0, 0)]
    return points, rs


def joined(df):
    x = df.selectExpr("pump_id", "signal", "detailed", "time", "bucket", "last", "reading.time as _t", "reading.value as _v")
    return sorted((tuple(r) for r in x.collect()), key=repr)


def test_asof_join_equals_brute_force(spark, monkeypatch):
    for seed, segment, seconds in ((1, 512, 3600), (2, 2, 600), (3, 3, 86400)):
        monkeypatch.setattr(asof, "SEGMENT", segment)
        points, rs = made(seed, 60, 120)
        p, r = spark.createDataFrame(points, POINTS), spark.createDataFrame(rs, READINGS)
        got = joined(asof.asof_join(p, r, seconds))
        assert got == brute(points, rs)
        assert sum(row[-1] is not None for row in got) > 20


def test_asof_join_with_stored_buckets_and_empty_sides(spark, tmp):
    points, rs = made(4, 20, 60)
    p, r = spark.createDataFrame(points, POINTS), spark.createDataFrame(rs, READINGS)
    half = r.where("pos < 30")
    # Appended in two parts: a bucket may then have two last readings.
    asof.bucket_last(half).write.parquet(f"{tmp}/b")
    asof.bucket_last(r.where("pos >= 30")).write.mode("append").parquet(f"{tmp}/b")
    assert joined(asof.asof_join(p, r, buckets=spark.read.parquet(f"{tmp}/b"))) == brute(points, rs)
    assert joined(asof.asof_join(p, r.limit(0))) == brute(points, [])
    assert asof.asof_join(p.limit(0), r).collect() == []


def test_asof_join_ignores_the_session_zone(spark):
    points, rs = made(5, 20, 60)
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        p, r = spark.createDataFrame(points, POINTS), spark.createDataFrame(rs, READINGS)
        assert joined(asof.asof_join(p, r)) == brute(points, rs)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_asof_join_deals_a_hot_series_by_time(spark):
    """One pump with a third of the rows: no task sorts a whole series."""
    start = "timestamp_ntz'2024-01-01 00:00:00'"
    at = f"{start} + make_dt_interval(0, 0, 0, id * 20)"
    r = spark.range(30_000).selectExpr(
        "if(id % 3 = 0, 'hot', concat('p', id % 500)) as pump_id", "'status' as signal", "false as detailed",
        f"{at} as time", "double(id) as value", "id as pos",
    )
    p = r.where("pos % 7 = 0").select("pump_id", "signal", "detailed", "time")
    x = asof.asof_join(p, r)
    assert x.where("reading.time = time").count() == p.count()
    text = plan(x)
    # Windows over readings and points are dealt by series and bucket; one over
    # segments alone is dealt by series.
    dealt = re.findall(r"hashpartitioning\(([^)]*)\)", text)
    assert any("bucket" in d for d in dealt) and "CartesianProduct" not in text
    assert r.groupBy("pump_id", asof.bucket_of().alias("b")).count().agg({"count": "max"}).first()[0] <= 180
