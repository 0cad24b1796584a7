"""Bundles, counts and series documents.

Series are gathered in chunks of a bucket of time: a document of a pump is a
run of chunk rows, complete and in order, never one row with all its history.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigfleet.functions.labels import points_label
from sigfleet.functions.timefmt import lookback_number, ntz
from sigfleet.operators.scans import range_scan
from sigfleet.schemas import HISTORY_SIGNALS, TOTAL_LABEL


def signal_counts(readings: DataFrame, signals) -> DataFrame:
    """A1: points per asked-for signal (0 when absent) plus a grand total.

    ``readings`` is already restricted to the pump(s) and range asked for.
    One global aggregate with a ``count_if`` per asked-for signal (partial
    on every map task, one row per task crosses the exchange), then the
    single result row is unpivoted in place: no join, no rollup shuffle.
    """
    signals = list(dict.fromkeys(signals))
    sig, has_time = F.col("signal"), F.col("time").isNotNull()
    counts = readings.agg(*[F.count_if((sig == s) & has_time).alias(f"_c{i}") for i, s in enumerate(signals)])
    total = reduce(lambda a, b: a + b, [F.col(f"_c{i}") for i in range(len(signals))])
    entries = [F.struct(F.lit(s).alias("signal"), F.col(f"_c{i}").alias("points")) for i, s in enumerate(signals)]
    entries.append(F.struct(F.lit(TOTAL_LABEL).alias("signal"), total.alias("points")))
    rows = counts.select(F.inline(F.array(*entries)))
    return rows.select("signal", "points", points_label("points").alias("label"))


# Hours of a day that one series chunk covers (a divisor of 24).
BUCKET = 1


def bucket_of(bucket: int = BUCKET):
    """Start (NTZ) of the bucket of a day that a reading's ``time`` lies in."""
    hour = F.floor(F.hour("time") / bucket) * bucket
    return F.to_date("time").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hour.cast("int"))


def series_array(where=None):
    """Aggregate: ordered ``array<struct<time,pos,value,validity>>`` of the
    readings (matching ``where``); empty when there is none."""
    one = F.struct("time", "pos", "value", "validity")
    return F.array_sort(F.collect_list(one if where is None else F.when(where, one)))


def series_chunks(
    readings: DataFrame, keys=("pump_id", "signal", "detailed"), bucket: int = BUCKET
) -> DataFrame:
    """``keys, chunk, points, datos``: the series of a key in chunks.

    A chunk holds the readings of one ``bucket`` hours in order; chunks in
    order of ``chunk`` are the whole series. A hot pump is thereby dealt by
    time, and no row or task grows with its history.
    """
    keys = list(keys)
    return readings.groupBy(*keys, bucket_of(bucket).alias("chunk")).agg(
        F.count(F.lit(1)).alias("points"), series_array().alias("datos")
    )


def history(readings: DataFrame, now, hours=24, signals=HISTORY_SIGNALS, pump_ids=None) -> DataFrame:
    """Detailed readings of the history signals over the last ``hours``
    hours (a number, or the text a user typed)."""
    h = lookback_number(hours)
    start = now - dt.timedelta(hours=h)
    return range_scan(readings, pump_ids, signals, start, now, detailed=True)


def history_document(readings: DataFrame, now, hours=24, signals=HISTORY_SIGNALS) -> DataFrame:
    """U3 document: per pump and chunk ``periodo`` and ``datos`` = map
    signal -> series in the service's form."""
    h = lookback_number(hours)
    chunks = series_chunks(history(readings, now, hours, signals))
    one = F.struct("signal", service_items("datos"))
    return (
        chunks.groupBy("pump_id", "chunk")
        .agg(F.map_from_entries(F.collect_list(one)).alias("datos"))
        .select(
            F.col("pump_id").alias("bomba_id"),
            F.struct(
                ntz(now - dt.timedelta(hours=h)).alias("inicio"),
                ntz(now).alias("fin"),
                F.lit(h).alias("horas"),
            ).alias("periodo"),
            F.col("chunk").alias("parte"),
            "datos",
        )
    )


def service_time(col):
    """``yyyy-MM-ddTHH:mm:ss[.ffffff]Z``: fractions only where there are any."""
    whole = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss")
    micro = F.date_format(col, "SSSSSS")
    return F.concat(
        whole,
        F.when(micro == "000000", F.lit("")).otherwise(F.concat(F.lit("."), micro)),
        F.lit("Z"),
    )


def service_items(column: str):
    """A series array as the service sends it: no position, times as text."""
    return F.transform(
        F.col(column),
        lambda x: F.struct(
            service_time(x["time"]).alias("time"),
            x["value"].alias("value"),
            x["validity"].alias("validity"),
        ),
    )
