"""The canonical ``readings`` table: Parquet partitioned by signal and day.

Layout: ``<path>/signal=<code>/day=<yyyy-MM-dd>/part-*.parquet``, each file
sorted by ``(pump_id, time, pos)``.

* ``signal`` and ``day`` predicates prune directories (``PartitionFilters``);
* inside a file, rows are clustered by pump, so the Parquet min/max
  statistics of ``pump_id`` and ``time`` let a one-pump or short-range scan
  skip row groups (``PushedFilters``).

The write range-partitions on ``(signal, day, pump_id, time)``: Spark samples
the key distribution, so a pump holding a large share of the rows is cut
into several files instead of landing in one task.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sigfleet.functions.timefmt import ntz

# Different pumps that the Bloom filter of a row group is laid out for (about 120 KB).
BLOOM_PUMPS = 100_000

COLUMNS = ["pump_id", "signal", "detailed", "time", "value", "validity", "pos"]


def write_readings(
    readings: DataFrame,
    path: str,
    files: int | None = None,
    mode: str = "overwrite",
    max_records_per_file: int = 5_000_000,
    dynamic: bool = False,
    extra: tuple[str, ...] = (),
) -> None:
    """Write canonical readings to the partitioned table at ``path``.

    ``files`` is the number of range partitions (output tasks); by default
    the session's shuffle partition count. ``dynamic`` replaces only the
    partitions that have new rows; ``extra`` columns come along.

    Pump ids get Bloom filters: the pumps of a day lie in every file of it, so
    that ranges alone do not tell where one pump is.
    """
    spark = readings.sparkSession
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = readings.select(*COLUMNS, *extra).withColumn("day", F.to_date("time"))
    df = df.repartitionByRange(n, "signal", "day", "pump_id", "time")
    # Sorted by the partition columns first: the partitioned writer would
    # otherwise sort by them itself and lose the order inside a file.
    df = df.sortWithinPartitions("signal", "day", "pump_id", "time", "pos")
    (
        df.write.mode(mode)
        .option("maxRecordsPerFile", max_records_per_file)
        .option("parquet.bloom.filter.enabled#pump_id", "true")
        .option("parquet.bloom.filter.expected.ndv#pump_id", str(BLOOM_PUMPS))
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .partitionBy("signal", "day")
        .parquet(path)
    )


KEY = ["pump_id", "signal", "detailed", "time"]


def merge_readings(readings: DataFrame, path: str, files: int | None = None) -> None:
    """Add readings to the table: landing the same or an overlapping range
    again changes nothing.

    Only the ``(signal, day)`` partitions that the new readings touch are
    read and replaced. Of a ``KEY`` in both, the readings of the new landing
    stay, all of them; readings without a time are added unless the table has
    as many equal ones. For repeated landings at volume see
    :mod:`sigfleet.sources.readings_log`, which rewrites nothing.
    """
    spark = readings.sparkSession
    new = readings.select(*COLUMNS, F.to_date("time").alias("day"), F.lit(1).alias("_new"))
    rows = new
    try:
        old = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    else:
        touched = new.select("signal", "day").distinct()
        same = F.expr("o.signal <=> t.signal and o.day <=> t.day")
        kept = old.alias("o").join(touched.alias("t"), same, "left_semi")
        rows = new.unionByName(kept.select(*COLUMNS, "day", F.lit(0).alias("_new")))
    # A landing replaces a key whole; without a time, every reading is a key of
    # its own, known by all of its columns and its number among equal ones.
    rest = [c for c in COLUMNS if c not in KEY]
    timeless = F.col("time").isNull()
    equal = Window.partitionBy(*COLUMNS, "_new").orderBy("pos")
    nth = F.when(timeless, F.struct(*rest, F.row_number().over(equal).alias("nth")))
    newest = F.max("_new").over(Window.partitionBy(*KEY, "_own"))
    current = rows.withColumn("_own", nth).withColumn("_newest", newest).where("_new = _newest")
    write_readings(current, path, files, mode="overwrite", dynamic=True)


def scan_readings(
    spark: SparkSession,
    path: str,
    signals=None,
    pump_ids=None,
    start=None,
    end=None,
) -> DataFrame:
    """Readings of the table with every predicate stated on the stored
    columns: ``signal`` and ``day`` prune directories, ``pump_id`` and
    ``time`` are pushed to the Parquet reader. Bounds are inclusive."""
    df = spark.read.parquet(path)
    if signals is not None:
        df = df.where(F.col("signal").isin(list(signals)))
    if pump_ids is not None:
        df = df.where(F.col("pump_id").isin(list(pump_ids)))
    if start is not None:
        df = df.where((F.col("time") >= ntz(start)) & (F.col("day") >= F.to_date(ntz(start))))
    if end is not None:
        df = df.where((F.col("time") <= ntz(end)) & (F.col("day") <= F.to_date(ntz(end))))
    return df
