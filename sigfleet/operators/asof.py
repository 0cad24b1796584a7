"""Value in force at a time, without scanning all history (P5 carry-in, A4).

``daily_last`` keeps, per pump, signal and calendar day, the last reading of
that day: one row per key per active day, so a sensor sampling every 30 s
shrinks 2,880-fold. It is built by one grouped pass (partial aggregation,
skew-safe) and can be appended day by day.

The reading in force at ``t`` is then the last of
* the ``daily_last`` rows of the days before ``t``'s day, and
* the readings of ``t``'s own day up to ``t``;
both inputs are day-pruned, so a carry-in query reads the compact index
plus one day of readings instead of the whole history. Exact: equal to
the full-history answer (tested).

``asof_join`` answers for a whole table of series and times at once: the
series are cut into buckets of time, a scan over the buckets' last readings
gives what each bucket starts with, and only buckets that are asked for look
at their own readings.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigfleet.functions.ordering import last_of
from sigfleet.functions.timefmt import ntz
from sigfleet.operators.scans import time_range

FILES_PER_DAY = 8
KEYS = ["pump_id", "signal", "detailed"]


def daily_last(readings: DataFrame) -> DataFrame:
    """``(pump_id, signal, detailed, day, <others>)``: last reading per key and day."""
    rest = [c for c in readings.columns if c not in KEYS + ["day"]]
    per_day = readings.withColumn("day", F.to_date("time"))
    g = per_day.groupBy(*KEYS, "day").agg(last_of(rest).alias("_l"))
    return g.select(*KEYS, "day", "_l.*")


def write_daily_last(readings: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write the index partitioned by day (append one day at a time with
    ``mode='append'`` on readings of that day)."""
    index = daily_last(readings)
    # All rows of a day meet in a few tasks, so a day gets a few files, not one per task.
    dealt = index.repartition("day", F.pmod(F.xxhash64("pump_id"), F.lit(FILES_PER_DAY)))
    dealt.write.mode(mode).partitionBy("day").parquet(path)


def latest_from_index(readings: DataFrame, index: DataFrame) -> DataFrame:
    """A4 served by the index: the last reading per pump and series.

    Reads one row per key and active day, and only those readings whose day
    is later than the newest indexed one; equal to the full-history answer
    for keys whose last reading is old as well.
    """
    newest = index.agg(F.max("day")).first()[0]
    fresh = readings if newest is None else time_range(
        readings, dt.datetime.combine(newest + dt.timedelta(days=1), dt.time()), None
    )
    cols = [c for c in index.columns if c not in [*KEYS, "day"]]
    both = index.select(*KEYS, *cols).unionByName(fresh.select(*KEYS, *cols))
    return both.groupBy(*KEYS).agg(last_of(cols).alias("_l")).select(*KEYS, "_l.*")


def in_force_at(readings: DataFrame, index: DataFrame, at) -> DataFrame:
    """Per pump and signal, the last reading at or before ``at``."""
    day = F.to_date(ntz(at))
    older = index.where(F.col("day") < day).drop("day")
    today = time_range(readings, None, at)
    today = today.where(F.col("time") >= day.cast("timestamp_ntz"))
    if "day" in today.columns:
        today = today.where(F.col("day") == day).drop("day")
    cols = [c for c in today.columns if c not in KEYS]
    both = today.select(*KEYS, *cols).unionByName(older.select(*KEYS, *cols))
    return both.groupBy(*KEYS).agg(last_of(cols).alias("_l")).select(*KEYS, "_l.*")


def range_carry_in_indexed(readings: DataFrame, index: DataFrame, start, end=None) -> DataFrame:
    """P5 with carry-in using the ``daily_last`` index: rows in
    ``(start, end]`` plus the reading in force at ``start``."""
    inside = time_range(readings, start, end).where(F.col("time") > ntz(start)).drop("day")
    carried = in_force_at(readings, index, start)
    return inside.unionByName(carried.select(*inside.columns))


# --- as-of join: the reading in force at each of many times ------------------

BUCKET = 3600  # seconds
SEGMENT = 512  # buckets that one task scans in order


def bucket_of(time: str = "time", seconds: int = BUCKET) -> Column:
    """Number of the bucket of ``seconds`` that holds a time."""
    # From the parts of the wall clock: no session time zone takes part.
    clock = F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)
    day = F.datediff(F.to_date(time), F.lit(dt.date(1970, 1, 1))).cast("long")
    return F.floor((day * 86400 + clock) / seconds).cast("long")


def bucket_last(readings: DataFrame, seconds: int = BUCKET, keys=KEYS) -> DataFrame:
    """``(*keys, bucket, last)``: the last reading of each series and bucket.

    One grouped pass, combined on the map side. It may be stored and passed to
    :func:`asof_join` again, as ``daily_last`` is for single times.
    """
    rest = [c for c in readings.columns if c not in keys]
    x = readings.where("time IS NOT NULL").withColumn("bucket", bucket_of("time", seconds))
    return x.groupBy(*keys, "bucket").agg(last_of(rest).alias("last"))


def _starts(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Per series and bucket, the last reading of the buckets before it.

    A scan in two levels: inside segments of ``SEGMENT`` buckets, then over one
    row per segment, so a task holds ``SEGMENT`` buckets of a series, and a
    segment's carry is one of few rows however long or dense the series is.
    """
    x = cells.withColumn("segment", F.floor(F.col("bucket") / SEGMENT))
    inside = Window.partitionBy(*keys, "segment").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    above = Window.partitionBy(*keys).orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    bucket = F.when(F.col("last").isNotNull(), F.col("bucket"))
    segments = x.groupBy(*keys, "segment").agg(F.max_by("last", bucket).alias("_l"))
    segments = segments.select(*keys, "segment", F.last("_l", ignorenulls=True).over(above).alias("_before"))
    here = x.withColumn("_inside", F.last("last", ignorenulls=True).over(inside))
    return here.join(segments, [*keys, "segment"]).select(
        *keys, "bucket", "asked", F.coalesce("_inside", "_before").alias("carried")
    )


def asof_join(
    points: DataFrame,
    readings: DataFrame,
    seconds: int = BUCKET,
    buckets: DataFrame | None = None,
    keys=KEYS,
    name: str = "reading",
) -> DataFrame:
    """``points`` (``*keys``, ``time`` and any other columns) with the struct
    ``name``: the last reading of the same series at or before the point's
    time, null if there is none.

    Each row of ``points`` comes back once, repeated ones as often. Among
    readings of one time the last position counts. A point with a null key or
    time has no reading; readings without a time are in force never. An empty
    side gives null readings or no rows. ``points`` must not bring a column
    called ``name``; other columns may have any names.

    A series never stands in one task: its rows are dealt by bucket of time,
    both for its readings and for the times asked, and times asked more than
    once are asked once. Readings of buckets that nobody asks for are only
    combined into ``buckets`` (:func:`bucket_last` of the same width).
    """
    keys = list(keys)
    rest = [c for c in readings.columns if c not in keys]
    cells = bucket_last(readings, seconds, keys) if buckets is None else buckets
    known = F.lit(True)
    for c in [*keys, "time"]:
        known = known & F.col(c).isNotNull()
    times = points.where(known).select(*keys, "time").distinct()
    times = times.withColumn("bucket", bucket_of("time", seconds))
    # The time to ask for counts as a row of its bucket, so every asked bucket has a start.
    wanted = times.select(*keys, "bucket").distinct()
    both = cells.select(*keys, "bucket", "last", F.lit(0).alias("asked")).unionByName(
        wanted.withColumn("asked", F.lit(1)), allowMissingColumns=True
    )
    merged = both.groupBy(*keys, "bucket").agg(
        F.max_by("last", F.struct("last.time", "last.pos")).alias("last"), F.max("asked").alias("asked")
    )
    starts = _starts(merged, keys).where("asked = 1 AND carried IS NOT NULL")

    value = F.struct(*[F.col(c) for c in rest])
    own = readings.where("time IS NOT NULL").withColumn("bucket", bucket_of("time", seconds))
    own = own.join(wanted, [*keys, "bucket"], "left_semi")
    none = F.lit(None).cast("long")
    rows = (
        starts.select(*keys, "bucket", F.lit(0).alias("_kind"), F.col("carried.time").alias("_at"), none.alias("_pos"), F.col("carried").alias("_r"))
        .unionByName(own.select(*keys, "bucket", F.lit(1).alias("_kind"), F.col("time").alias("_at"), F.col("pos").alias("_pos"), value.alias("_r")))
        .unionByName(
            times.select(*keys, "bucket", F.lit(2).alias("_kind"), F.col("time").alias("_at"), none.alias("_pos")),
            allowMissingColumns=True,
        )
    )
    # At one time: what was carried, the readings by position, the question.
    so_far = Window.partitionBy(*keys, "bucket").orderBy("_at", "_kind", "_pos").rowsBetween(Window.unboundedPreceding, 0)
    answered = rows.withColumn("_r", F.last("_r", ignorenulls=True).over(so_far)).where("_kind = 2")
    return points.join(
        answered.select(*keys, F.col("_at").alias("time"), F.col("_r").alias(name)), [*keys, "time"], "left"
    ).select(*points.columns, name)
