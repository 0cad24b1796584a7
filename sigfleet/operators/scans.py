"""Range scans over readings.

Sources push their own predicates (see ``sigfleet.sources``); these
operators state the same predicates on canonical columns, so they are also
correct on any readings DataFrame and cost nothing when already pushed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigfleet.functions.links import endpoint_signals
from sigfleet.functions.ordering import last_of
from sigfleet.functions.timefmt import ntz


def time_range(df: DataFrame, start=None, end=None, col: str = "time") -> DataFrame:
    """P5: inclusive ``start <= time <= end``; a ``None`` bound is open.

    When the table is partitioned by ``day`` the matching day predicate is
    added too, since Catalyst does not derive it from ``time``.
    """
    c = F.col(col)
    if start is not None:
        df = df.where(c >= ntz(start))
        if "day" in df.columns:
            df = df.where(F.col("day") >= F.to_date(ntz(start)))
    if end is not None:
        df = df.where(c <= ntz(end))
        if "day" in df.columns:
            df = df.where(F.col("day") <= F.to_date(ntz(end)))
    return df


def range_scan(
    readings: DataFrame,
    pump_ids=None,
    signals=None,
    start=None,
    end=None,
    detailed: bool | None = None,
) -> DataFrame:
    """Readings of the chosen pumps and signals inside a range.

    ``pump_ids``/``signals`` ``None`` = all; the fleet-wide form is the
    default. ``start > end`` simply yields no rows.
    """
    df = readings
    if pump_ids is not None:
        df = df.where(F.col("pump_id").isin(list(pump_ids)))
    if signals is not None:
        df = df.where(F.col("signal").isin(list(signals)))
    if detailed is not None:
        df = df.where(F.col("detailed") == F.lit(detailed))
    return time_range(df, start, end)


def signal_select(readings: DataFrame, endpoint: str, pump_ids=None, start=None, end=None) -> DataFrame:
    """Readings for a menu endpoint name (single signal or bundle)."""
    signals, detailed = endpoint_signals(endpoint)
    return range_scan(readings, pump_ids, signals, start, end, detailed)


def select_endpoints(readings: DataFrame, endpoints) -> DataFrame:
    """Readings of a list of endpoint names, plain and detailed mixed
    (e.g. ``["status", "detailed_status", "power", "speed", "faults"]``)."""
    pred = F.lit(False)
    for name in endpoints:
        codes, detailed = endpoint_signals(name)
        pred = pred | (F.col("signal").isin(list(codes)) & (F.col("detailed") == F.lit(detailed)))
    return readings.where(pred)


def range_carry_in(readings: DataFrame, start, end=None, keys=("pump_id", "signal", "detailed")) -> DataFrame:
    """P5 with carry-in: rows in ``(start, end]`` plus, per pump and series,
    the last row at or before ``start`` (the value in force at the start).

    The carried row is picked by a grouped "last by (time, pos)" aggregate,
    run partially on the map side, so a hot pump never lands whole in one
    task. The two branches read disjoint time ranges of one table.
    """
    keys = list(keys)
    rest = [c for c in readings.columns if c not in keys]
    # The lower bound stated inclusively as well: it also prunes days.
    inside = time_range(readings, start, end).where(F.col("time") > ntz(start))
    before = time_range(readings, None, start)
    carried = before.groupBy(*keys).agg(last_of(rest).alias("_l")).select(*keys, "_l.*")
    return inside.unionByName(carried.select(*inside.columns))
