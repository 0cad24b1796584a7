"""Fleet report, wide record, offline exclusion, de-duplication
(A2, A5, J1, J3, J4, P7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigfleet.operators.bundles import BUCKET, bucket_of, series_array
from sigfleet.operators.latest import latest_per_signal

# Column prefix per signal in the wide record.
WIDE_SIGNALS = {
    "status": "status",
    "rawpower": "power",
    "speed": "speed",
    "fault": "faults",
    "inservice": "inservice",
}


def pump_flags(readings: DataFrame, fault_pred: Column | None = None) -> DataFrame:
    """Per pump with any reading: ``has_faults`` (a fault reading matching
    ``fault_pred``; default: any fault reading at all), status/power
    availability and ``processed``. Grouped, partially aggregated."""
    fp = F.lit(True) if fault_pred is None else fault_pred
    sig = F.col("signal")
    return readings.groupBy("pump_id").agg(
        F.bool_or((sig == "fault") & fp).alias("has_faults"),
        F.bool_or(sig == "status").alias("status_available"),
        F.bool_or(sig == "rawpower").alias("power_available"),
        F.lit(True).alias("processed"),
    )


def report_rows(pumps: DataFrame, readings: DataFrame, fault_pred: Column | None = None) -> DataFrame:
    """A2 per-pump rows; J1: pumps without readings stay, all flags false."""
    flags = pump_flags(readings, fault_pred)
    j = pumps.select("pump_id", "name").join(flags, "pump_id", "left")
    return j.select(
        "pump_id",
        "name",
        *[F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("has_faults", "status_available", "power_available", "processed")],
    )


def outcome_report_rows(pumps: DataFrame, outcomes: DataFrame) -> DataFrame:
    """A2 from fetch outcomes (``sigfleet.sources.payloads.fetch_outcomes``).

    ``has_faults`` keeps the historical meaning (a fault fetch returned a
    non-empty list); ``faults_known`` tells whether any fault fetch actually
    answered, so a failed fetch no longer reads as "no faults" (D7).
    Availability uses the same truthiness rule for status and power.
    """
    sig = F.col("signal")
    answered = F.col("outcome").isin("ok", "empty", "object")
    flags = outcomes.groupBy("pump_id").agg(
        F.bool_or((sig == "fault") & F.col("is_nonempty")).alias("has_faults"),
        F.bool_or((sig == "fault") & answered).alias("faults_known"),
        F.bool_or((sig == "status") & F.col("is_nonempty")).alias("status_available"),
        F.bool_or((sig == "rawpower") & F.col("is_nonempty")).alias("power_available"),
        F.lit(True).alias("processed"),
    )
    j = pumps.select("pump_id", "name").join(flags, "pump_id", "left")
    cols = ("has_faults", "faults_known", "status_available", "power_available", "processed")
    return j.select("pump_id", "name", *[F.coalesce(F.col(c), F.lit(False)).alias(c) for c in cols])


def fleet_summary(rows: DataFrame) -> DataFrame:
    """A2 totals over :func:`report_rows` (a global partial aggregate)."""
    return rows.agg(
        F.count(F.lit(1)).alias("total_pumps"),
        F.count_if("processed").alias("processed"),
        F.count_if("has_faults").alias("with_faults"),
    )


def wide_record(
    pumps: DataFrame,
    readings: DataFrame,
    detailed: bool = False,
    signals=WIDE_SIGNALS,
    bucket: int = BUCKET,
) -> DataFrame:
    """``pump_id, name, chunk`` and one series array per signal.

    A pump's record is a run of chunks, one per ``bucket`` hours with any
    reading, in order of ``chunk`` (the bucket's start); together they hold
    the whole series, so neither a row nor a task ever holds a pump's whole
    history. A pump without readings has one row with a null chunk and empty
    series. One grouped pass, not one join per signal.
    """
    scoped = readings.where(
        F.col("signal").isin(list(signals)) & (F.col("detailed") == F.lit(detailed))
    )
    parts = scoped.groupBy("pump_id", bucket_of(bucket).alias("chunk")).agg(
        *[series_array(F.col("signal") == s).alias(p) for s, p in signals.items()]
    )
    return (
        pumps.select("pump_id", "name")
        .join(parts, "pump_id", "left")
        .select(
            "pump_id", "name", "chunk",
            *[F.coalesce(F.col(p), F.array()).alias(p) for p in signals.values()],
        )
    )


def offline_pumps(readings: DataFrame, offline: Column | None = None) -> DataFrame:
    """Pumps whose latest plain ``inservice`` reading is "off" (default value = 0)."""
    off = (F.col("value") == 0) if offline is None else offline
    plain = readings.where((F.col("signal") == "inservice") & ~F.col("detailed"))
    last = latest_per_signal(plain, keys=("pump_id",))
    return last.where(off).select("pump_id")


def exclude_offline(pumps: DataFrame, readings: DataFrame, offline: Column | None = None) -> DataFrame:
    """Drop out-of-service pumps; a pump with no in-service reading stays."""
    return pumps.join(offline_pumps(readings, offline), "pump_id", "left_anti")


def dedupe_last(df: DataFrame, key: str, order: str, cols) -> DataFrame:
    """A5: per ``key`` keep the record with the greatest ``order`` (the last
    one in source order wins). A grouped ``max_by``: partial aggregate,
    safe when one key holds a large share of the records."""
    cols = list(cols)
    last = F.max_by(F.struct(*cols), F.col(order)).alias("_m")  # one struct: the columns of one record
    return df.groupBy(key).agg(F.max(order).alias(order), last).select(key, order, *[f"_m.{c}" for c in cols])
