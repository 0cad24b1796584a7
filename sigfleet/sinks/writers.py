"""Result documents and exports.

Everything is written by Spark's distributed writers; nothing is gathered
on the driver. Documents are one JSON object per line (JSON Lines) so each
file is written and later read in parallel.
"""

from __future__ import annotations

from contextlib import nullcontext

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigfleet.functions.labels import default_name, file_key, file_stamp, utc_now
from sigfleet.functions.links import endpoint_signals
from sigfleet.functions.timefmt import ntz
from sigfleet.operators.bundles import series_chunks, service_items
from sigfleet.operators.scans import range_scan
from sigfleet.schemas import DEFAULT_EXPORT_PREFIX, ENDPOINTS, HISTORY_FILE_PREFIX, WIDE_FILE_PREFIX
from sigfleet.session import setting
from sigfleet.sinks.named_files import write_named_files

FORMATS = ("json", "csv")
COALESCE = "spark.sql.adaptive.coalescePartitions.enabled"
MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def result_documents(readings: DataFrame, pumps: DataFrame, endpoint: str, start, end, now) -> DataFrame:
    """Result documents of every pump for ``endpoint`` over a range.

    Single-signal endpoints give ``datos`` as an array; bundles give a map
    endpoint -> array (``all_basic`` keys ``status``/``power``/``speed``).
    A pump's document comes in parts, one per time bucket with readings
    (``parte`` is the bucket's start), in order the whole series; a pump
    without readings has one part with empty series.
    """
    signals, detailed = endpoint_signals(endpoint)
    scoped = range_scan(readings, signals=signals, start=start, end=end, detailed=detailed)
    chunks = series_chunks(scoped).select(
        "pump_id", "signal", "chunk", service_items("datos").alias("datos")
    )
    empty = F.array().cast("array<struct<time:string,value:double,validity:int>>")
    base = pumps.select("pump_id", "name")
    if len(signals) == 1:
        base = base.join(chunks.select("pump_id", "chunk", "datos"), "pump_id", "left")
        datos = F.coalesce(F.col("datos"), empty)
    else:
        names = {codes[0]: name for name, (codes, det) in ENDPOINTS.items() if len(codes) == 1 and det == detailed}
        key = F.create_map(*[x for s in signals for x in (F.lit(s), F.lit(names[s]))])[F.col("signal")]
        parts = chunks.groupBy("pump_id", "chunk").agg(
            F.map_from_entries(F.collect_list(F.struct(key, "datos"))).alias("_m")
        )
        base = base.join(parts, "pump_id", "left")
        datos = F.map_from_entries(
            F.array(*[F.struct(F.lit(names[s]), F.coalesce(F.try_element_at("_m", F.lit(names[s])), empty)) for s in signals])
        )
    fmt = "yyyy-MM-dd'T'HH:mm:ss"
    stamp = lambda t: F.lit(None).cast("string") if t is None else F.date_format(ntz(t), fmt)
    return base.select(
        file_key(endpoint, F.col("name"), now).alias("file_key"),
        F.struct(F.col("pump_id").cast("string").alias("id"), default_name("name").alias("name")).alias("bomba"),
        F.lit(endpoint).alias("endpoint"),
        F.struct(stamp(start).alias("inicio"), stamp(end).alias("fin")).alias("rango"),
        F.col("chunk").alias("parte"),
        datos.alias("datos"),
        F.date_format(ntz(now), fmt).alias("timestamp_consulta"),
    )


def write_documents(docs: DataFrame, path: str, partition_by=("endpoint",)) -> None:
    """K1/K2: JSON Lines, UTF-8, non-ASCII kept; partitioned by endpoint."""
    w = docs.write.mode("overwrite").option("encoding", "UTF-8")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.json(path)


def _name_part(text) -> Column:
    """A text as one part of a path: slashes (and a lone dot or two) encoded."""
    t = F.replace(F.replace(text, F.lit("%"), F.lit("%25")), F.lit("/"), F.lit("%2F"))
    return F.when(t.isin("", ".", ".."), F.concat(F.lit("%"), F.hex(F.encode(t, "UTF-8")))).otherwise(t)


def document_files(docs: DataFrame, key: str = "file_key", pump: str = "bomba.id", part: str = "parte") -> DataFrame:
    """``file, content``: a JSON file per document part, named by its
    key, in a folder per pump (pumps without a name share a key).

    A part's name ends in its hour; the key itself is not part of the content.
    """
    hour = F.when(F.col(part).isNotNull(), F.concat(F.lit("_"), F.date_format(part, "yyyyMMddHH")))
    name = F.concat(_name_part(F.col(key)), F.coalesce(hour, F.lit("")), F.lit(".json"))
    body = F.struct(*[F.col(c) for c in docs.columns if c != key])
    text = F.to_json(body, {"timestampNTZFormat": MICROS, "ignoreNullFields": "false"})
    return docs.select(
        F.concat(_name_part(F.coalesce(F.col(pump).cast("string"), F.lit(""))), F.lit("/"), name).alias("file"),
        F.encode(text, "UTF-8").alias("content"),
    )


def wide_record_files(wide: DataFrame, now) -> DataFrame:
    """K6: ``file, content`` of the wide record, named by pump name and stamp."""
    docs = wide_record_documents(wide, now)
    name = F.replace(F.col("info.name"), F.lit(" "), F.lit("_"))
    key = F.concat_ws("_", F.lit(WIDE_FILE_PREFIX), name, file_stamp(now))
    return document_files(docs.withColumn("file_key", key), pump="bomba_id")


def history_files(history: DataFrame) -> DataFrame:
    """K7: ``file, content`` of history documents, named by pump id and days."""
    day = lambda c: F.date_format(c, "yyyyMMdd")
    key = F.concat_ws("_", F.lit(HISTORY_FILE_PREFIX), "bomba_id", day("periodo.inicio"), day("periodo.fin"))
    return document_files(history.withColumn("file_key", key), pump="bomba_id")


def write_document_files(docs: DataFrame, path: str, **names) -> None:
    """:func:`document_files` written below ``path``, one file each.

    Pump ids and parts tell the files of one table of documents apart.
    """
    write_named_files(document_files(docs, **names), path, unique=True)


def default_export_path(base_dir: str, now) -> str:
    """K2: default stamped output path ``<base>/fleet_data_{yyyyMMdd_HHmmss}``
    from the job's ``now`` (a datetime)."""
    return f"{base_dir.rstrip('/')}/{DEFAULT_EXPORT_PREFIX}_{now:%Y%m%d_%H%M%S}"


def wide_record_documents(wide: DataFrame, now) -> DataFrame:
    """K6: chunks of the wide record as JSON-ready rows (times as text)."""
    series = [c for c in wide.columns if c not in ("pump_id", "name", "chunk")]
    return wide.select(
        F.col("pump_id").alias("bomba_id"),
        F.struct(F.col("pump_id").cast("string").alias("id"), default_name("name").alias("name")).alias("info"),
        ntz(now).alias("timestamp"),
        F.col("chunk").alias("parte"),
        *[service_items(c).alias(c) for c in series],
    )


def write_output(
    df: DataFrame,
    path: str,
    fmt: str = "json",
    include_timestamp: bool = True,
    separate_files: bool = False,
    now=None,
) -> None:
    """K9 output knobs: format (json/csv), a ``fetched_at`` stamp column,
    one folder per pump and the path. With a folder per pump the rows are
    dealt by pump first, a large pump over several tasks, so that the files
    number about as many as the pumps and not pumps times tasks. Folders cost
    more than their bytes, so that small shares of pumps are not put together
    into one task."""
    if fmt not in FORMATS:
        raise ValueError(f"output format not supported: {fmt!r} (use one of {FORMATS})")
    if include_timestamp:
        df = df.withColumn("fetched_at", utc_now() if now is None else ntz(now))
    w = df.write.mode("overwrite")
    if separate_files:
        w = df.hint("rebalance", "pump_id").write.mode("overwrite").partitionBy("pump_id")
    with setting(df.sparkSession, COALESCE, "false") if separate_files else nullcontext():
        if fmt == "csv":
            _csv(w).csv(path)
        else:
            w.option("timestampNTZFormat", MICROS).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """K3/K4: CSV with a header row and no index column."""
    _csv(df.write.mode("overwrite")).csv(path)


def _csv(writer):
    """Header, standard doubled quotes, blanks of a text and fractions of a
    second kept."""
    return writer.options(
        header=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        timestampNTZFormat=MICROS,
    )


def latest_export(latest_wide: DataFrame, now) -> DataFrame:
    """K3 columns of the latest-value table."""
    return latest_wide.select(
        F.col("pump_id").alias("ID"),
        default_name("name").alias("Nombre"),
        ntz(now).alias("Timestamp"),
        F.col("status_time").isNotNull().alias("Estado_Disponible"),
        F.col("power_time").isNotNull().alias("Potencia_Disponible"),
        F.col("status_value").alias("Estado_Valor"),
        F.col("status_time").alias("Estado_Tiempo"),
        F.col("power_value").alias("Potencia_Valor"),
        F.col("power_time").alias("Potencia_Tiempo"),
    )


def report_documents(summary: DataFrame, rows: DataFrame, path: str, now) -> None:
    """K5: the report as two JSON outputs: the totals (one line) and the
    per-pump rows (one line each). The per-pump list is not gathered into
    one array, since the fleet has no size bound."""
    stamp = ntz(now)
    summary.select(
        stamp.alias("timestamp"),
        F.col("total_pumps").alias("total_bombas"),
        F.col("processed").alias("bombas_procesadas"),
        F.col("with_faults").alias("bombas_con_fallos"),
    ).coalesce(1).write.mode("overwrite").json(f"{path}/summary")
    rows.select(
        F.col("pump_id").alias("id"), "name", "has_faults", "status_available", "power_available"
    ).write.mode("overwrite").json(f"{path}/resumen_por_bomba")
