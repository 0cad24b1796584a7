"""Samples of series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def series_sample(readings: DataFrame, n: int = 3, keys=("pump_id", "signal", "detailed")) -> DataFrame:
    """First ``n`` readings by ``(time, pos)`` of each series.

    ``row_number() <= n`` is planned with a partial ``WindowGroupLimit``
    before the shuffle, so each map task sends at most ``n`` rows per key:
    a hot pump is cut down where it is read, not in one reducer.
    """
    w = Window.partitionBy(*keys).orderBy("time", "pos")
    return readings.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
