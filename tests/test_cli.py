"""End to end: land files like a collector, ingest, then run the jobs."""

import datetime as dt
import glob
import json

from pyspark.sql import functions as F

from sigfleet import cli
from sigfleet.sources import driver_tables as dtab
from sigfleet.sources import landing
from tests.conftest import SF_SMOKE

NOW = "2024-01-30T00:00:00"


def land_payload_files(spark, path):
    """One body file per pump, signal and day under pump_id=/signal=/day=."""
    bodies = landing.landed_bodies(dtab.readings(spark, SF_SMOKE))
    out = bodies.select(
        "pump_id", "signal", "detailed", F.date_format("fetched_at", "yyyyMMddHH").alias("hour"), F.to_date("fetched_at").cast("string").alias("day"), F.col("body").cast("string").alias("value")
    )
    out.write.mode("overwrite").partitionBy("pump_id", "signal", "detailed", "day", "hour").text(path)


def test_ingest_and_jobs(spark, tmp, capsys):
    land_payload_files(spark, f"{tmp}/landed")
    landing.land_catalog(dtab.pumps(spark, SF_SMOKE), f"{tmp}/catalog", per_file=50)
    cli.main(["ingest-payloads", "--landed", f"{tmp}/landed", "--readings", f"{tmp}/readings", "--outcomes", f"{tmp}/outcomes"], spark)
    cli.main(["ingest-catalog", "--catalog", f"{tmp}/catalog", "--pumps", f"{tmp}/pumps", "--links", f"{tmp}/links"], spark)

    events = dtab.readings(spark, SF_SMOKE)
    assert spark.read.parquet(f"{tmp}/readings").count() == events.count()
    assert spark.read.parquet(f"{tmp}/pumps").count() == dtab.pumps(spark, SF_SMOKE).count()
    assert spark.read.parquet(f"{tmp}/links").count() == 16 * dtab.pumps(spark, SF_SMOKE).count()
    assert {r.outcome for r in spark.read.parquet(f"{tmp}/outcomes").select("outcome").distinct().collect()} == {"ok"}

    capsys.readouterr()
    cli.main(
        ["query", "--readings", f"{tmp}/readings", "--pumps", f"{tmp}/pumps", "--endpoint", "all_basic",
         "--pump", "7", "--start", "2024-01-05", "--end", "2024-01-20", "--now", NOW, "--out", f"{tmp}/q"],
        spark,
    )
    printed = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    want = events.where(
        (F.col("pump_id") == 7)
        & F.col("signal").isin("status", "rawpower", "speed")
        & ~F.col("detailed")
        & (F.col("time") >= dt.datetime(2024, 1, 5))
        & (F.col("time") <= dt.datetime(2024, 1, 20, 23, 59, 59))
    ).count()
    assert {p["signal"]: p["points"] for p in printed}["TOTAL"] == want
    docs = spark.read.json(f"{tmp}/q")
    assert {d.bomba.id for d in docs.collect()} == {"7"}
    assert docs.select("parte").distinct().count() == docs.count()

    cli.main(["latest", "--readings", f"{tmp}/readings", "--pumps", f"{tmp}/pumps", "--now", NOW, "--out", f"{tmp}/latest"], spark)
    assert spark.read.option("header", True).csv(f"{tmp}/latest").count() == dtab.pumps(spark, SF_SMOKE).count()

    cli.main(["report", "--readings", f"{tmp}/readings", "--pumps", f"{tmp}/pumps", "--now", NOW, "--out", f"{tmp}/rep",
              "--faults-from", f"{tmp}/outcomes"], spark)
    s = spark.read.json(f"{tmp}/rep/summary").first()
    assert s.total_bombas == dtab.pumps(spark, SF_SMOKE).count()

    cli.main(["history", "--readings", f"{tmp}/readings", "--pump", "7", "--hours", "48", "--now", NOW, "--out", f"{tmp}/h"], spark)
    assert glob.glob(f"{tmp}/h/part-*")

    cli.main(["monitor", "--landing", f"{tmp}/readings", "--sink", f"{tmp}/mon", "--checkpoint", f"{tmp}/ck", "--once"], spark)
    from sigfleet.streaming.monitors import read_latest

    assert read_latest(spark, f"{tmp}/mon").count() == events.select("pump_id", "signal", "detailed").distinct().count()


def test_rejected_range_text(spark, tmp):
    import pytest

    with pytest.raises(SystemExit):
        cli._range(spark, "not a date", "", dt.datetime(2024, 1, 30))
