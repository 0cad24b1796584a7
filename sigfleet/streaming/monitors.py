"""Structured Streaming monitors.

Every monitor writes through ``foreachBatch`` into per-batch Parquet
directories ``<sink>/batch_id=N``. A retried batch overwrites its own
directory, so the sinks are idempotent (exactly-once with the checkpoint).

* T1 keeps one row per pump and signal in the state store (bounded by the
  fleet). Each batch writes a *snapshot*: the previous snapshot merged with
  the keys that changed in the batch, so the sink holds whole answers,
  readers read only the newest snapshot, and the per-batch cost is bounded
  by the fleet, not by the history. A retried batch rebuilds its snapshot
  from the same predecessor.
* T1 with labels (:func:`start_label_monitor`) keeps a timer per series: a
  series from which nothing comes for a while gets the "no data" label, and
  its value again with its next reading.
* T2 and T3 keep no state; their sinks are logs (one entry per poll and
  pump, one per alert). T3 leaves out what its sink already holds; that sink
  is laid out by day of the fault, then by batch.
"""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sigfleet.functions.labels import default_name
from sigfleet.functions.ordering import last_of
from sigfleet.schemas import LANDED_SCHEMA, NO_DATA, READINGS_SCHEMA
from sigfleet.session import setting, work_path
from sigfleet.sinks.named_files import listed_by_tasks, listing_tasks, qualified, stream_new_files, with_content
from sigfleet.sources.payloads import landed_rows, readings_from_landed
from sigfleet.streaming.silence import FORGET_AFTER, labels_stream


def _batch_writer(sink: str, fn=None):
    def write(batch: DataFrame, batch_id: int) -> None:
        out = fn(batch, batch_id) if fn else batch
        out.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    return write


def _start(df: DataFrame, sink: str, checkpoint: str, mode: str, trigger: dict, fn=None, name=None) -> StreamingQuery:
    w = df.writeStream.outputMode(mode).foreachBatch(_batch_writer(sink, fn)).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    return w.trigger(**trigger).start()


SERIES = ["pump_id", "signal", "detailed"]
# Snapshots of T1 that stay behind the newest one (readers may be on them).
KEEP_SNAPSHOTS = 3
SHUFFLE = "spark.sql.shuffle.partitions"

# --- T1: latest value per pump and signal ---------------------------------

def latest_state(readings_stream: DataFrame) -> DataFrame:
    """Stateful aggregate: the last reading by ``(time, pos)`` per key,
    with its ordering key so sink batches can be merged. ``max_by`` is
    idempotent, so re-landing a payload changes nothing."""
    return readings_stream.groupBy(*SERIES).agg(last_of(["time", "pos", "value"]).alias("_l"))


def state_tasks(spark: SparkSession) -> int:
    """Parts of the state of T1: as many as a stream's listing has tasks, or
    the session's shuffle partitions where these are fewer."""
    return min(int(spark.conf.get(SHUFFLE)), listing_tasks(spark))


def _snapshot_ids(spark: SparkSession, sink: str) -> list[int]:
    """Batch ids of the complete snapshots under ``sink`` (listing only)."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(sink)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    ids = []
    for st in fs.listStatus(path):
        name = st.getPath().getName()
        if name.startswith("batch_id=") and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            ids.append(int(name.split("=", 1)[1]))
    return sorted(ids)


def _drop_snapshot(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _merge_snapshot(sink: str):
    known: list[int] = []  # complete snapshots, listed once per start

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not known or known[-1] >= batch_id:  # a start, or a batch run again
            known[:] = [b for b in _snapshot_ids(spark, sink) if b < batch_id]
        cur = batch.select(*SERIES, "_l.*")
        if known:
            last = spark.read.parquet(f"{sink}/batch_id={known[-1]}")
            cur = cur.unionByName(last.select(*SERIES, "_l.*"))
        merged = cur.groupBy(*SERIES).agg(last_of(["time", "pos", "value"]).alias("_l"))
        merged.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")
        known.append(batch_id)
        while len(known) > KEEP_SNAPSHOTS + 1:
            _drop_snapshot(spark, f"{sink}/batch_id={known.pop(0)}")

    return write


def start_latest_monitor(
    readings_stream: DataFrame, sink: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Every trigger (default 30 s) merge the keys whose latest value
    changed into a new snapshot of the fleet's latest values.

    A new checkpoint deals the state over :func:`state_tasks` parts, and so are
    the snapshots: every part costs some files with every batch, however few
    keys it has. An existing checkpoint keeps its own number.
    """
    trigger = trigger or {"processingTime": "30 seconds"}
    spark = readings_stream.sparkSession
    w = (
        latest_state(readings_stream)
        .writeStream.outputMode("update")
        .foreachBatch(_merge_snapshot(sink))
        .option("checkpointLocation", checkpoint)
    )
    with setting(spark, SHUFFLE, state_tasks(spark)):  # a query keeps the settings of its start
        return w.trigger(**trigger).start()


def read_latest(spark: SparkSession, sink: str) -> DataFrame:
    """Current latest values from a T1 sink: ``(pump_id, signal, detailed,
    value, time)`` (the newest complete snapshot)."""
    ids = _snapshot_ids(spark, sink)
    if not ids:
        return spark.createDataFrame([], "pump_id bigint, signal string, detailed boolean, value double, time timestamp_ntz")
    s = spark.read.parquet(f"{sink}/batch_id={ids[-1]}")
    return s.select(*SERIES, F.col("_l.value").alias("value"), F.col("_l.time").alias("time"))


def latest_labels(spark: SparkSession, sink: str, chosen_pumps: DataFrame, signal: str = "status") -> DataFrame:
    """T1 as shown: the chosen pumps with their latest plain value of one
    signal as text, or the "no data" label."""
    now = read_latest(spark, sink).where((F.col("signal") == signal) & ~F.col("detailed"))
    return (
        chosen_pumps.select("pump_id", "name")
        .join(now.select("pump_id", "value", "time"), "pump_id", "left")
        .select(
            "pump_id",
            default_name("name").alias("name"),
            F.coalesce(F.col("value").cast("string"), F.lit(NO_DATA)).alias("value"),
            "time",
        )
    )


def landed_readings_stream(spark: SparkSession, path: str) -> DataFrame:
    """Readings from a stream of landed payload rows (Parquet, S3's form)."""
    return readings_from_landed(spark.readStream.schema(LANDED_SCHEMA).parquet(path))


BINARY_FILES = "path string, modificationTime timestamp, length long, content binary"


def landed_files_stream(
    spark: SparkSession, path: str, pump_id: str = "pump_id", signal: str = "signal", files_per_trigger: int | None = None
) -> DataFrame:
    """Readings from a stream of payload files (one body per file, folders
    ``pump_id=…/signal=…/detailed=…``), the stream of ``read_landed_files``.

    Files must appear whole (written elsewhere and renamed). One of zero bytes
    gives no reading; it is an outcome of the batch reader alone.

    Tasks list the files and read them (:func:`stream_new_files`): a trigger
    takes all that is new, and there is a batch per trigger. With
    ``files_per_trigger``, or where tasks do not reach the store or ``path`` is
    a pattern, Spark's file source lists them on the driver, which then takes so
    many at a time. A checkpoint stays with the source that began it.
    """
    if files_per_trigger is None and _exists(spark, path) and listed_by_tasks(spark, path):
        found = with_content(stream_new_files(spark, path), path)
        files = found.select(
            F.concat(F.lit(qualified(spark, path) + "/"), "file").alias("path"),
            F.timestamp_millis("modified").alias("modificationTime"),
            "length",
            "content",
        )
        key = lambda c: F.nullif(F.regexp_extract("path", f"/{c}=([^/]+)/", 1), F.lit(""))
        files = files.select("*", *[key(c).alias(c) for c in dict.fromkeys((pump_id, signal, "detailed"))])
    else:
        schema = f"{BINARY_FILES}, {pump_id} string, {signal} string, detailed string"
        read = spark.readStream.format("binaryFile").schema(schema)
        files = read.option("maxFilesPerTrigger", files_per_trigger or 10_000).load(path)
    return readings_from_landed(landed_rows(files, pump_id, signal))


# --- T1 with labels: series that fall silent --------------------------------

# The state store that keeps timers and lets old state expire.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _merge_labels(sink: str):
    known: list[int] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not known or known[-1] >= batch_id:
            known[:] = [b for b in _snapshot_ids(spark, sink) if b < batch_id]
        cur = batch.withColumn("seq", F.lit(batch_id).cast("long"))
        if known:
            cur = cur.unionByName(spark.read.parquet(f"{sink}/batch_id={known[-1]}"))
        rest = [c for c in cur.columns if c not in SERIES]
        merged = cur.groupBy(*SERIES).agg(F.max_by(F.struct(*rest), "seq").alias("_l"))
        merged.select(*SERIES, "_l.*").write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")
        known.append(batch_id)
        while len(known) > KEEP_SNAPSHOTS + 1:
            _drop_snapshot(spark, f"{sink}/batch_id={known.pop(0)}")

    return write


def start_label_monitor(
    readings_stream: DataFrame,
    sink: str,
    checkpoint: str,
    trigger: dict | None = None,
    silent_after: float = 90.0,
    forget_after: float = FORGET_AFTER,
) -> StreamingQuery:
    """T1 with labels: per series its latest value, or the "no data" label
    once nothing has come from it for ``silent_after`` seconds.

    A reading that is older than the latest one shows that the series is alive
    but does not change its value. A series silent for ``forget_after``
    seconds leaves the state (its label stays in the sink); should it come
    back, it starts anew.
    """
    trigger = trigger or {"processingTime": "30 seconds"}
    spark = readings_stream.sparkSession
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKS_DB)  # a query keeps the settings of its start
    try:
        return (
            labels_stream(readings_stream, silent_after, forget_after)
            .writeStream.outputMode("update")
            .foreachBatch(_merge_labels(sink))
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .start()
        )
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)


def stop_when_idle(q: StreamingQuery, seconds: float = 600.0) -> None:
    """Stop a query once it has read all that has landed. A query with timers
    never ends by itself, not even when started for what is available now.

    The first batch of a start may be an earlier one run again, so only a later
    one without input tells. Stopping falls between two triggers when these lie
    further apart than a batch takes.
    """

    def nothing_new(progress) -> bool:
        clock = any("RatePerMicroBatch" in s["description"] for s in progress["sources"])
        files = [o["numRowsUpdated"] for o in progress["stateOperators"] if o["operatorName"] == "dedupe"]
        return progress["numInputRows"] == 0 or (clock and files != [] and not any(files))  # clock rows are no input

    end = time.monotonic() + seconds
    while q.isActive and time.monotonic() < end:
        seen = q.recentProgress
        if len(seen) > 1 and nothing_new(seen[-1]):
            q.stop()
            return
        time.sleep(0.1)
    if q.exception() is not None:
        raise q.exception()
    if q.isActive:
        q.stop()
        raise TimeoutError(f"the stream was still reading after {seconds} seconds")


def read_labels(spark: SparkSession, sink: str) -> DataFrame:
    """``pump_id, signal, detailed, label, value, time`` of the newest snapshot
    of :func:`start_label_monitor`; an empty table while there is none."""
    ids = _snapshot_ids(spark, sink)
    if not ids:
        ddl = "pump_id string, signal string, detailed boolean, label string, value double, time timestamp_ntz"
        return spark.createDataFrame([], ddl)
    return spark.read.parquet(f"{sink}/batch_id={ids[-1]}").drop("seq")


# --- T2: heartbeat of status and power -------------------------------------

def heartbeat_flags(batch: DataFrame, batch_id: int, chosen_pumps: DataFrame) -> DataFrame:
    """One poll = one micro-batch: for every chosen pump, did plain status
    and power data arrive. A pump from which nothing came is Error/Error."""
    seen = _seen(batch)
    label = lambda c: F.when(F.col(c) > 0, F.lit("OK")).otherwise(F.lit("Error"))
    return (
        chosen_pumps.select("pump_id")
        .distinct()
        .join(seen, "pump_id", "left")
        .select(
            F.lit(batch_id).cast("long").alias("poll"),
            "pump_id",
            label("status_points").alias("status"),
            label("power_points").alias("power"),
        )
    )


def start_heartbeat(
    readings_stream: DataFrame,
    chosen_pumps: DataFrame,
    sink: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Per poll (default every 10 s) OK/Error for status and power of
    the chosen pumps. Stateless: each batch is summarised on its own."""
    trigger = trigger or {"processingTime": "10 seconds"}
    flags = lambda batch, n: heartbeat_flags(batch, n, chosen_pumps)
    return _start(readings_stream, sink, checkpoint, "append", trigger, fn=flags)


def _seen(batch: DataFrame) -> DataFrame:
    """Plain status and power readings per pump of a batch."""
    sig = F.col("signal")
    return batch.where(~F.col("detailed")).groupBy("pump_id").agg(
        F.count_if(sig == "status").alias("status_points"), F.count_if(sig == "rawpower").alias("power_points")
    )


def run_heartbeat(
    readings_stream: DataFrame,
    chosen_pumps: DataFrame,
    sink: str,
    checkpoint: str,
    polls: int = 6,
    every: float = 10.0,
    before=None,
) -> DataFrame:
    """T2 as a bounded run: ``poll, pump_id, status, power`` of ``polls`` polls.

    A poll takes whatever has landed since the one before, in as many
    micro-batches as it takes, and then says OK or Error of every chosen pump:
    also when nothing at all has landed, where a trigger alone would be silent.
    ``before(n)`` is called ahead of poll ``n`` (from 0); ``every`` seconds lie
    between two polls. A run that stopped goes on after its last complete poll,
    with what the stopped poll had seen.
    """
    spark = readings_stream.sparkSession
    done = {n for n in range(polls) if _exists(spark, f"{sink}/poll={n}/_SUCCESS")}
    for n in range(polls):
        if n in done:
            continue
        if before:
            before(n)
        seen = f"{sink}/_seen/poll={n}"

        def write(batch: DataFrame, batch_id: int, seen=seen) -> None:
            _seen(batch).write.mode("overwrite").parquet(f"{seen}/batch={batch_id}")

        q = (
            readings_stream.writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
        ids = chosen_pumps.select("pump_id").distinct()
        if _exists(spark, seen):
            points = spark.read.parquet(seen).groupBy("pump_id").agg(
                F.sum("status_points").alias("status_points"), F.sum("power_points").alias("power_points")
            )
            rows = ids.join(points, "pump_id", "left")
        else:
            rows = ids.select("pump_id", F.lit(0).alias("status_points"), F.lit(0).alias("power_points"))
        label = lambda c: F.when(F.col(c) > 0, F.lit("OK")).otherwise(F.lit("Error"))
        rows.select("pump_id", label("status_points").alias("status"), label("power_points").alias("power")).write.mode(
            "overwrite"
        ).parquet(f"{sink}/poll={n}")
        if n + 1 < polls and every:
            time.sleep(every)
    return spark.read.option("basePath", sink).parquet(*[f"{sink}/poll={n}" for n in range(polls)])


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


# --- T3: fault alerts for selected pumps -----------------------------------

def fault_alerts_stream(readings_stream: DataFrame, chosen_pumps: DataFrame) -> DataFrame:
    """Stream-static join of fault readings with the chosen pumps."""
    faults = readings_stream.where(F.col("signal") == "fault")
    return faults.join(chosen_pumps.select("pump_id", "name"), "pump_id")


# A reading is known by (pump, series, time), not by its place in a payload,
# so a range landed again at another offset alerts once.
ALERT_KEY = [*SERIES, "time"]


def _days_of(batch: DataFrame) -> list:
    """The days of a batch's faults; null for those without a time."""
    return [r[0] for r in batch.select(F.to_date("time").alias("d")).distinct().collect()]


def _day_folders(spark: SparkSession, sink: str, days: list) -> list[str]:
    """The folders of these days that exist; no other folder is looked at."""
    jvm = spark._jvm
    names = [f"{sink}/day={'__HIVE_DEFAULT_PARTITION__' if d is None else d}" for d in days]
    paths = [jvm.org.apache.hadoop.fs.Path(n) for n in names]
    conf = spark._jsc.hadoopConfiguration()
    return [n for n, p in zip(names, paths, strict=True) if p.getFileSystem(conf).exists(p)]


def _write_alerts(sink: str):
    """Add the alerts of a batch that no earlier batch has written.

    The sink is laid out by day of the fault, then by batch: a batch reads the
    days of its own faults alone, whatever the age of the monitor. There is no
    watermark, so a fault alerts however late it lands and whatever the clocks
    of other pumps say. A batch run again looks only at its predecessors and
    replaces its own folders.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = batch.dropDuplicates(ALERT_KEY)
        folders = _day_folders(spark, sink, _days_of(batch))
        if folders:
            schema = batch.schema.add("day", "date").add("batch_id", "long")
            before = spark.read.schema(schema).option("basePath", sink).parquet(*folders)
            a, b = new.alias("a"), before.where(F.col("batch_id") < batch_id).select(*ALERT_KEY).alias("b")
            same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ALERT_KEY]
            new = a.join(b, same, "left_anti")
        out = new.withColumn("day", F.to_date("time")).withColumn("batch_id", F.lit(batch_id).cast("long"))
        w = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        w.partitionBy("day", "batch_id").parquet(sink)

    return write


def start_fault_alerts(
    readings_stream: DataFrame, chosen_pumps: DataFrame, sink: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Every trigger (default 30 s) the faults of the chosen pumps that
    have not alerted yet."""
    trigger = trigger or {"processingTime": "30 seconds"}
    alerts = fault_alerts_stream(readings_stream, chosen_pumps)
    w = alerts.writeStream.outputMode("append").foreachBatch(_write_alerts(sink))
    return w.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def read_alerts(spark: SparkSession, sink: str) -> DataFrame:
    """Alerts from a T3 sink; an empty table while there is none."""
    try:
        return spark.read.parquet(sink).drop("day", "batch_id")
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], READINGS_SCHEMA.add("name", "string"))


# --- bounded runs ----------------------------------------------------------

def run_available(spark: SparkSession, kind: str, start_fn, *args) -> str:
    """Run a monitor over everything available now, wait, return its sink.

    Sink and checkpoint are fresh folders under the shared checkpoint dir.
    """
    sink = work_path(spark, f"{kind}-sink")
    ck = work_path(spark, f"{kind}-checkpoint")
    q = start_fn(*args, sink, ck, {"availableNow": True})
    q.awaitTermination()
    exc = q.exception()
    if exc is not None:
        raise exc
    return sink
