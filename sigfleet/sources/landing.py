"""Land files in the collector's formats from canonical tables.

Used to feed the file readers (catalogue scan, result documents, payload
bodies, encoding repair) with data Spark derives from the driver tables.
All writes are distributed; each file holds a bounded number of records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigfleet.functions.links import fill_template
from sigfleet.operators.catalog_ops import signal_keys
from sigfleet.schemas import BOM, DETAILED_SUFFIX, PLACEHOLDER_BASE_URL

# Endpoint name of each signal in result documents.
SIGNAL_ENDPOINT = {"status": "status", "rawpower": "power", "speed": "speed", "fault": "faults", "inservice": "inservice"}
BASIC = ("status", "rawpower", "speed")


def _endpoint_name():
    """Endpoint name of a reading's series."""
    name = F.create_map(*[v for k, e in SIGNAL_ENDPOINT.items() for v in (F.lit(k), F.lit(e))])
    return F.concat(F.when(F.col("detailed"), F.lit("detailed_")).otherwise(F.lit("")), name[F.col("signal")])


def catalog_record_json(pumps: DataFrame, base: str = PLACEHOLDER_BASE_URL) -> DataFrame:
    """One JSON text per pump: ``id``, ``name`` and the 16 link objects."""
    fields = [F.col("pump_id").cast("string").alias("id"), F.col("name").alias("name")]
    for code, det in signal_keys():
        href = fill_template(F.col("pump_id"), F.lit(code), det, base)
        fields.append(F.struct(href.alias("href")).alias(code + (DETAILED_SUFFIX if det else "")))
    return pumps.select("pump_id", "source_pos", F.to_json(F.struct(*fields)).alias("_json"))


def land_catalog(pumps: DataFrame, path: str, per_file: int = 1000, bom: bool = True, envelope: bool = False) -> None:
    """Catalogue files of at most ``per_file`` records each, in source order:
    a JSON array (or ``{"results": [...]}``), optionally behind a BOM.

    Records are grouped by ``source_pos div per_file``, so a file never holds
    more than ``per_file`` records; ``partitionBy`` gives each its own file.
    """
    docs = _catalog_docs(pumps, per_file, bom, envelope)
    docs.write.mode("overwrite").partitionBy("_file").text(path)


def catalog_files(
    pumps: DataFrame, folder: str, per_file: int = 1000, bom: bool = True, envelope: bool = False
) -> DataFrame:
    """The same files as ``file, content`` rows: ``<folder>/<number>.json``."""
    docs = _catalog_docs(pumps, per_file, bom, envelope)
    return docs.select(
        F.concat(F.lit(f"{folder}/"), F.col("_file").cast("string"), F.lit(".json")).alias("file"),
        F.encode("value", "UTF-8").alias("content"),
    )


def _catalog_docs(pumps: DataFrame, per_file: int, bom: bool, envelope: bool) -> DataFrame:
    recs = catalog_record_json(pumps).withColumn("_file", F.floor(F.col("source_pos") / per_file))
    grouped = recs.groupBy("_file").agg(F.array_sort(F.collect_list(F.struct("source_pos", "_json"))).alias("_r"))
    arr = F.concat(F.lit("["), F.array_join(F.transform("_r", lambda x: x["_json"]), ","), F.lit("]"))
    doc = F.concat(F.lit('{"results": '), arr, F.lit("}")) if envelope else arr
    if bom:
        doc = F.concat(F.lit(BOM), doc)
    return grouped.select("_file", doc.alias("value"))


def _items(readings: DataFrame) -> DataFrame:
    """Readings with the reading object the service sends (sorts by time, pos)."""
    t = F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return readings.withColumn("_item", F.struct(t.alias("time"), "pos", "value", "validity"))


def _sorted_items(col: str = "_items"):
    return F.transform(F.array_sort(F.col(col)), lambda x: F.struct(x["time"].alias("time"), x["value"].alias("value"), x["validity"].alias("validity")))


def land_result_docs(readings: DataFrame, pumps: DataFrame, path: str) -> None:
    """Result documents as JSON Lines, one per pump and hour: an ``all_basic``
    or ``all_detailed`` bundle (object ``datos``) for status/power/speed and one single-signal
    document (array ``datos``) for each other signal. Every reading lands
    exactly once."""
    x = _items(readings).withColumn("_day", F.to_date("time")).withColumn("_hour", F.hour("time"))
    names = pumps.select("pump_id", "name")

    def doc_cols(endpoint):
        return [
            F.struct(F.col("pump_id").cast("string").alias("id"), F.col("name").alias("name")).alias("bomba"),
            endpoint.alias("endpoint"),
            F.struct(F.date_format("_day", "yyyy-MM-dd'T'00:00:00").alias("inicio"), F.date_format("_day", "yyyy-MM-dd'T'23:59:59").alias("fin")).alias("rango"),
        ]

    single = (
        x.where(~F.col("signal").isin(*BASIC))
        .groupBy("pump_id", "signal", "detailed", "_day", "_hour")
        .agg(F.collect_list("_item").alias("_items"))
        .join(names, "pump_id", "left")
    )
    single.select(*doc_cols(_endpoint_name()), _sorted_items().alias("datos")).write.mode("overwrite").json(f"{path}/single")

    per_sig = (
        x.where(F.col("signal").isin(*BASIC))
        .groupBy("pump_id", "signal", "detailed", "_day", "_hour")
        .agg(F.collect_list("_item").alias("_items"))
    )
    bundle = per_sig.groupBy("pump_id", "detailed", "_day", "_hour").agg(
        F.map_from_entries(F.collect_list(F.struct(_endpoint_name(), _sorted_items()))).alias("datos")
    ).join(names, "pump_id", "left")
    ep = F.when(F.col("detailed"), F.lit("all_detailed")).otherwise(F.lit("all_basic"))
    bundle.select(*doc_cols(ep), "datos").write.mode("overwrite").json(f"{path}/bundle")


def landed_bodies(readings: DataFrame) -> DataFrame:
    """Landed rows whose body is the reading array of one pump, series and
    hour, the way the service answers a one-hour range query."""
    x = _items(readings).withColumn("_day", F.to_date("time")).withColumn("_hour", F.hour("time"))
    g = x.groupBy("pump_id", "signal", "detailed", "_day", "_hour").agg(
        F.collect_list("_item").alias("_items")
    )
    return g.select(
        F.col("pump_id").cast("string").alias("pump_id"),
        "signal",
        "detailed",
        (F.col("_day").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("_hour"))).alias(
            "fetched_at"
        ),
        F.lit(200).alias("http_status"),
        F.lit(None).cast("string").alias("error"),
        F.encode(F.to_json(_sorted_items()), "UTF-8").alias("body"),
    )


def payload_files(readings: DataFrame, days: int = 31) -> DataFrame:
    """``file, content``: the readings of a pump, series and ``days`` days as
    one payload, at ``pump_id=…/signal=…/detailed=…/<first day>.json``."""
    first = F.date_add(F.lit("1970-01-01").cast("date"), (F.floor(F.unix_date(F.to_date("time")) / days) * days).cast("int"))
    g = _items(readings).groupBy("pump_id", "signal", "detailed", first.alias("_first"))
    part = lambda c: F.concat(F.lit(f"{c}="), F.col(c).cast("string"))
    name = F.concat(F.coalesce(F.col("_first").cast("string"), F.lit("no-time")), F.lit(".json"))
    docs = g.agg(F.collect_list("_item").alias("_items"))
    return docs.select(
        F.concat_ws("/", part("pump_id"), part("signal"), part("detailed"), name).alias("file"),
        F.encode(F.to_json(_sorted_items()), "UTF-8").alias("content"),
    )
