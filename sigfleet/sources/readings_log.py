"""The readings table as an append log: landings are added, never rewritten.

Layout: ``<path>/run=<number>-add/signal=<code>/day=<yyyy-MM-dd>/part-*``,
one folder per landing, and ``run=<number>-base/…`` for a compacted state.
A folder counts once its ``_SUCCESS`` is there, so a reader never sees half a
landing; writing a run again replaces that run's folder alone.

Which readings are current (``resolved``):

* within one landing every reading stays, also readings of one time with
  different or equal values;
* between landings, the newest landing that has readings of a key
  (pump, signal, detailed, time) gives all readings of that key;
* a reading without a time has no key to be replaced by. It is told by its
  payload (series, fetch time and body) and its place there: a payload landed
  again adds nothing, any other payload adds its readings.

``compact`` writes the resolved state of the newest runs as a base beside the
landings and then drops what it covers. Stopped in between, the old folders
are merely ignored, and dropped by the next compaction. Reading costs a
shuffle on the key only while there are landings beyond the base, and that one
is partial on days: predicates on signal, day, pump and time reach the scan.

Defined cases: no folder at all reads as an empty table; an empty landing adds
an empty run; null pumps, signals and values are kept like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sigfleet.functions.timefmt import ntz
from sigfleet.sources.readings_table import COLUMNS, KEY, write_readings

ADD, BASE = "add", "base"
SCHEMA = (
    "pump_id string, detailed boolean, time timestamp_ntz, value double, validity int, pos long, "
    "payload string, landing long, run string, signal string, day date"
)


def payload_id(landed_columns=("pump_id", "signal", "detailed", "fetched_at", "body")) -> Column:
    """Identity of a landed payload: equal for the same fetch landed again."""
    parts = [F.coalesce(F.hex(F.col(c).cast("binary")) if c == "body" else F.col(c).cast("string"), F.lit("-"))
             for c in landed_columns]
    return F.sha2(F.concat_ws("|", *parts), 256)


def runs(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """``(number, kind)`` of the complete folders, in order (a listing of folders)."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    out = []
    for st in fs.listStatus(root) if fs.exists(root) else []:
        number, _, kind = st.getPath().getName().removeprefix("run=").partition("-")
        if kind in (ADD, BASE) and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            out.append((int(number), kind))
    return sorted(out)


def _folder(path: str, number: int, kind: str) -> str:
    return f"{path.rstrip('/')}/run={number}-{kind}"


def live(found: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """The newest base and the landings after it."""
    base = max((n for n, kind in found if kind == BASE), default=None)
    return [(n, k) for n, k in found if (k == BASE and n == base) or (k == ADD and (base is None or n > base))]


def append_readings(
    readings: DataFrame, path: str, run: int | None = None, files: int | None = None
) -> int:
    """Add a landing; returns its number (by default the next).

    ``readings`` may have a ``payload`` column (see :func:`payload_id`); without
    one, readings that have no time are told by their own columns.
    """
    spark = readings.sparkSession
    if run is None:
        run = max((n for n, _ in runs(spark, path)), default=0) + 1
    own = F.sha2(F.to_json(F.struct(*COLUMNS)), 256)
    payload = F.col("payload") if "payload" in readings.columns else own
    rows = readings.select(*COLUMNS, payload.alias("payload"), F.lit(run).cast("long").alias("landing"))
    write_readings(rows, _folder(path, run, ADD), files, extra=("payload", "landing"))
    return run


def resolved(rows: DataFrame) -> DataFrame:
    """The current readings among the rows of several landings."""
    timeless = F.col("time").isNull()
    of_payload = F.when(timeless, F.struct("payload", "pos"))
    newest = F.max("landing").over(Window.partitionBy(*KEY, of_payload))
    return rows.withColumn("_newest", newest).where("landing = _newest").drop("_newest")


def scan_log(
    spark: SparkSession, path: str, signals=None, pump_ids=None, start=None, end=None
) -> DataFrame:
    """Current readings; every predicate reaches the scan, bounds inclusive."""
    there = live(runs(spark, path))
    folders = [_folder(path, n, k) for n, k in there]
    if folders:
        rows = spark.read.schema(SCHEMA).option("basePath", path).parquet(*folders)
    else:
        rows = spark.createDataFrame([], SCHEMA)
    # All of these are on key columns: filtering first leaves whole keys.
    if signals is not None:
        rows = rows.where(F.col("signal").isin(list(signals)))
    if pump_ids is not None:
        rows = rows.where(F.col("pump_id").isin([str(p) for p in pump_ids]))
    if start is not None:
        rows = rows.where((F.col("time") >= ntz(start)) & (F.col("day") >= F.to_date(ntz(start))))
    if end is not None:
        rows = rows.where((F.col("time") <= ntz(end)) & (F.col("day") <= F.to_date(ntz(end))))
    if len(there) > 1:
        rows = resolved(rows)
    return rows.select(*COLUMNS, "day")


def compact(spark: SparkSession, path: str, files: int | None = None, drop: bool = True) -> int | None:
    """Write the current state as a base and drop what it covers.

    Safe to repeat and to stop anywhere: the base counts once complete, and
    what a stopped compaction left behind goes with the next.
    """
    found = runs(spark, path)
    there = live(found)
    if not there:
        return None
    number = there[-1][0]
    if len(there) > 1 or there[0][1] == ADD:
        rows = spark.read.schema(SCHEMA).option("basePath", path).parquet(*[_folder(path, n, k) for n, k in there])
        kept = resolved(rows) if len(there) > 1 else rows
        write_readings(kept, _folder(path, number, BASE), files, extra=("payload", "landing"))
    if drop:
        jvm = spark._jvm
        for n, kind in found:
            if (n, kind) != (number, BASE) and n <= number:
                p = jvm.org.apache.hadoop.fs.Path(_folder(path, n, kind))
                p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return number
