"""Latest value per pump and signal (A4) and its wide form.

"Latest" is the last reading by ``(time, pos)``, computed as a grouped
``max_by(struct(fields), struct(time, pos))`` (``sigfleet.functions.ordering``):
Spark runs it partially on every map task before the shuffle, so the
shuffle carries at most one row per key per task however skewed the pumps
are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigfleet.functions.ordering import last_of

# Column name prefix of each signal in the wide form.
WIDE_PREFIX = {"status": "status", "rawpower": "power"}


def latest_per_signal(readings: DataFrame, keys=("pump_id", "signal", "detailed"), fields=("value",)) -> DataFrame:
    """``(keys..., time, fields...)`` of the last reading per key; the plain
    and the detailed series of a signal are two series."""
    keys = list(keys)
    cols = ["time", *fields]
    return readings.groupBy(*keys).agg(last_of(cols).alias("_l")).select(*keys, *[f"_l.{c}" for c in cols])


def latest_wide(
    pumps: DataFrame, readings: DataFrame, signals=WIDE_PREFIX, detailed: bool = False
) -> DataFrame:
    """One row per catalogue pump with ``<prefix>_value``/``<prefix>_time``
    per signal, plain or detailed; null where the pump has no such reading.

    One aggregation (one shuffle on ``pump_id``) produces every signal's
    latest value at once, then a left join keeps pumps without data. The
    join strategy is left to AQE, which broadcasts a side only when its
    measured size is under the threshold.
    """
    aggs = [
        last_of(
            ["value", "time"], (F.col("signal") == sig) & (F.col("detailed") == F.lit(detailed))
        ).alias(f"_{p}")
        for sig, p in signals.items()
    ]
    cols = []
    for p in signals.values():
        cols += [F.col(f"_{p}.value").alias(f"{p}_value"), F.col(f"_{p}.time").alias(f"{p}_time")]
    latest = readings.groupBy("pump_id").agg(*aggs).select("pump_id", *cols)
    return pumps.select("pump_id", "name").join(latest, "pump_id", "left")
