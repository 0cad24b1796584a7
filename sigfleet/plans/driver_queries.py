"""The registered queries: library operators applied to the driver tables.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame over the
*whole* tables. Parameters (pump 7, the ranges, "now") are the fixed job
arguments of the correctness check; see ``sigfleet.plans.oracle``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigfleet.functions.labels import file_key as file_key_col
from sigfleet.functions.labels import safe_size
from sigfleet.functions.links import absolute_link, link_href, publication_link, signal_key
from sigfleet.functions.timefmt import format_time as format_time_col
from sigfleet.functions.timefmt import lookback_hours, lookback_start, range_end, range_start
from sigfleet.operators import asof, bundles, catalog_ops, latest, reports, samples, scans
from sigfleet.schemas import HISTORY_SIGNALS, NO_DATA, PLACEHOLDER_BASE_URL, READING_ARRAY_DDL
from sigfleet.session import short_listing, work_path
from sigfleet.plans.ingest import ingest_payloads
from sigfleet.sinks import bom, writers
from sigfleet.sinks.named_files import read_named_files, write_named_files
from sigfleet.sources import catalog, landing, payloads, result_docs
from sigfleet.sources import driver_tables as dtab
from sigfleet.sources.payloads import reading_time
from sigfleet.sources.readings_log import compact, scan_log
from sigfleet.streaming import monitors

NOW = dt.datetime(2024, 1, 30, 0, 0, 0)
PUMP = 7
RANGE = (dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 20))
CARRY = (dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 11))
SERIES = ["pump_id", "signal", "detailed"]
# Signals to collect.
COLLECT = ["status", "detailed_status", "power", "speed", "faults"]
BASIC = ("status", "rawpower", "speed", "aaecontrol")
# Fault predicate and "off" rule for the driver data (continuous values).
FAULT_OVER = 200.0
OFF_UNDER = 20.0
LABEL_TRIGGER = {"processingTime": "4 seconds"}
# Records of a landed catalogue file.
FILE_RECORDS = 20


def _r(spark, sf, **kw) -> DataFrame:
    return dtab.readings(spark, sf, **kw)


def _p(spark, sf) -> DataFrame:
    return dtab.pumps(spark, sf)


def q_range_scan(spark: SparkSession, sf: str) -> DataFrame:
    r = _r(spark, sf, signals=["rawpower"], pump_ids=[PUMP], start=RANGE[0], end=RANGE[1])
    df = scans.range_scan(r, pump_ids=[PUMP], signals=["rawpower"], start=RANGE[0], end=RANGE[1])
    return df.select("pump_id", "signal", "time", "value", "pos")


def q_range_scan_open(spark, sf):
    r = _r(spark, sf, signals=["fault"], pump_ids=[PUMP])
    return scans.range_scan(r, pump_ids=[PUMP], signals=["fault"]).select("pump_id", "signal", "time", "value", "pos")


def q_range_carry_in(spark, sf):
    r = _r(spark, sf, end=CARRY[1])
    return scans.range_carry_in(r.select(*SERIES, "time", "value", "pos"), CARRY[0], CARRY[1]).select(
        *SERIES, "time", "value"
    )


def _daily_index(spark, sf, end=None):
    """The daily-last index, built here into the shared folder; in
    production it is maintained once per day."""
    path = work_path(spark, "daily-last")
    asof.write_daily_last(_r(spark, sf, end=end).select(*SERIES, "time", "value", "pos"), path)
    return spark.read.parquet(path)


def q_range_carry_in_indexed(spark, sf):
    """Carry-in served by the daily-last index."""
    index = _daily_index(spark, sf)
    r = _r(spark, sf, start=CARRY[0] - dt.timedelta(days=1), end=CARRY[1]).select(*SERIES, "time", "value", "pos")
    return asof.range_carry_in_indexed(r, index, CARRY[0], CARRY[1]).select(*SERIES, "time", "value")


def q_latest_indexed(spark, sf):
    """A4 from an index that ends before the newest readings."""
    index = _daily_index(spark, sf, end=RANGE[1])
    r = _r(spark, sf).select(*SERIES, "time", "value", "pos")
    return asof.latest_from_index(r, index).select(*SERIES, "time", "value")


def q_signal_select(spark, sf):
    """The signals to collect, plain and detailed mixed."""
    r = scans.select_endpoints(_r(spark, sf), COLLECT)
    return r.select(*SERIES, "time", "value")


def q_detailed_select(spark, sf):
    """The detailed bundle by its endpoint name."""
    r = _r(spark, sf, pump_ids=[PUMP], detailed=True)
    return scans.signal_select(r, "all_detailed", [PUMP]).select(*SERIES, "time", "value")


def q_signal_counts(spark, sf):
    r = _r(spark, sf, signals=BASIC, detailed=False)
    return bundles.signal_counts(r, BASIC)


def q_individual_query(spark, sf):
    """U4: the three basic signals of one pump over the last day, with counts."""
    sigs = ("status", "rawpower", "speed")
    start = NOW - dt.timedelta(days=1)
    r = _r(spark, sf, signals=sigs, pump_ids=[PUMP], start=start, end=NOW, detailed=False)
    return bundles.signal_counts(r, sigs)


def q_latest_per_signal(spark, sf):
    return latest.latest_per_signal(_r(spark, sf)).select(*SERIES, "time", "value")


def q_latest_wide(spark, sf):
    r = _r(spark, sf, signals=["status", "rawpower"], detailed=False)
    return latest.latest_wide(_p(spark, sf), r)


def _fault_over():
    return F.col("value") > FAULT_OVER


def q_report_rows(spark, sf):
    rows = reports.report_rows(_p(spark, sf), _r(spark, sf), _fault_over())
    return rows.select("pump_id", "name", "has_faults", "status_available", "power_available")


def q_fleet_report(spark, sf):
    return reports.fleet_summary(reports.report_rows(_p(spark, sf), _r(spark, sf), _fault_over()))


def q_exclude_offline(spark, sf):
    r = _r(spark, sf, signals=["inservice"])
    return reports.exclude_offline(_p(spark, sf), r, F.col("value") < OFF_UNDER).select("pump_id", "name")


def q_fault_alerts(spark, sf):
    chosen = catalog_ops.name_filter(_p(spark, sf), ["0001", "77"])
    r = _r(spark, sf, signals=["fault"])
    return chosen.join(r, "pump_id").select("pump_id", "name", "time", "value")


def q_name_filter(spark, sf):
    return catalog_ops.name_filter(_p(spark, sf), ["012", "77"]).select("pump_id", "name")


def q_id_names(spark, sf):
    return catalog_ops.id_names(_p(spark, sf))


def q_valid_ids(spark, sf):
    """Ids are missing or blank for two nations of five."""
    c = dtab.table(spark, sf, "customer")
    k = F.col("c_nationkey") % 5
    text_id = F.when(k == 0, F.lit(None)).when(k == 1, F.lit("")).otherwise(F.col("c_custkey").cast("string"))
    ids = c.select(text_id.alias("pump_id"), F.col("c_name").alias("name"))
    return catalog_ops.valid_ids(ids).select(F.col("pump_id").cast("long").alias("pump_id"), "name")


def q_head_n(spark, sf):
    return catalog_ops.head_n(_p(spark, sf), 10).select("pump_id", "name")


def q_dedupe_last(spark, sf):
    o = dtab.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("pump_id"), F.col("o_orderkey").alias("last_order"), F.col("o_orderstatus").alias("status")
    )
    return reports.dedupe_last(o, "pump_id", "last_order", ["status"])


def q_links_workset(spark, sf):
    return catalog_ops.links_workset(_p(spark, sf))


def q_links_count(spark, sf):
    return catalog_ops.links_count(catalog_ops.links_map(_p(spark, sf)))


def q_link_lookup(spark, sf):
    """links as some catalogues give them: relative for every
    third pump, absent for every fifth; looked up, made absolute."""
    p = catalog_ops.links_map(_p(spark, sf))
    key = signal_key(F.lit("speed"), True)
    relative = F.col("pump_id") % 3 == 0
    host = F.lit(PLACEHOLDER_BASE_URL + "/")
    links = F.transform_values("links", lambda k, v: F.when(relative, F.replace(v, host, F.lit(""))).otherwise(v))
    links = F.map_filter(links, lambda k, v: (F.col("pump_id") % 5 != 0) | (k != key))
    p = p.withColumn("links", links)
    return p.select("pump_id", absolute_link(link_href("links", "speed/detailed")).alias("href"))


def q_links_rewrite(spark, sf):
    base = PLACEHOLDER_BASE_URL
    p = _p(spark, sf).select("pump_id", F.concat(F.lit(base + "/"), F.col("pump_id"), F.lit("/speed/")).alias("href"))
    # Which links are schedule links (served under the publication base).
    schedule = F.col("pump_id") % 2 == 0
    return p.withColumn("href", F.when(schedule, publication_link("href", "pump_id", base)).otherwise(F.col("href")))


def q_pump_info(spark, sf):
    return catalog_ops.pump_info(catalog_ops.links_map(_p(spark, sf)), [PUMP])


def q_file_key(spark, sf):
    return _p(spark, sf).select("pump_id", file_key_col("status", F.col("name"), NOW, blank="#").alias("file_key"))


def q_series_sample(spark, sf):
    return samples.series_sample(_r(spark, sf), 3).select(*SERIES, "time", "value")


def q_history_export(spark, sf):
    r = _r(spark, sf, signals=HISTORY_SIGNALS, start=NOW - dt.timedelta(hours=24), end=NOW, detailed=True)
    return bundles.history(r, NOW, "24").select(*SERIES, "time", "value")


def q_catalog_fallback(spark, sf):
    primary = dtab.table(spark, sf, "customer").select(
        F.lit("primary").alias("origin"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("unit")
    )
    snapshot = dtab.table(spark, sf, "supplier").select(
        F.lit("snapshot").alias("origin"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("unit")
    )
    # Load outcome per unit: the primary load of odd nations failed.
    outcomes = dtab.table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("unit"),
        F.when(F.col("n_nationkey") % 2 == 1, "error").otherwise("ok").alias("outcome"),
    )
    return catalog_ops.with_fallback(primary, snapshot, outcomes, "unit").select("origin", "name")


def q_catalog_fallback_files(spark, sf):
    """S2 by file: of the primary files every third is missing and every third
    is cut short; the snapshot of all of them stands in."""
    primary, snapshot = work_path(spark, "catalog-primary"), work_path(spark, "catalog-snapshot")
    files = landing.catalog_files(_p(spark, sf), "list", per_file=FILE_RECORDS, bom=True)
    write_named_files(files, snapshot, unique=True)
    number = F.regexp_extract("file", "([0-9]+)[.]json$", 1).cast("long")
    cut = F.expr("substring(content, 1, length(content) - 1)")
    part = files.where(number % 3 != 1).withColumn("content", F.when(number % 3 == 2, cut).otherwise(F.col("content")))
    write_named_files(part, primary, unique=True)
    return catalog.catalog_with_file_fallback(spark, primary, snapshot).select("file", "pump_id", "name", "origin")


def q_state_at_fault(spark, sf):
    """As-of join: each fault reading with the plain status in force then."""
    faults = _r(spark, sf, signals=["fault"]).select("pump_id", "time", F.col("pos").alias("fault_pos"))
    points = faults.select("*", F.lit("status").alias("signal"), F.lit(False).alias("detailed"))
    status = _r(spark, sf, signals=["status"], detailed=False).select(*SERIES, "time", "value", "pos")
    x = asof.asof_join(points, status)
    return x.select(
        "pump_id", "time", "fault_pos", F.col("reading.value").alias("status"), F.col("reading.time").alias("since")
    )


def q_in_force_per_pump(spark, sf):
    """P5/W3 with a start of its own per pump: every series' value in force."""
    start = F.lit(RANGE[0]) + F.make_dt_interval(F.lit(0), (F.col("pump_id") % 480).cast("int"))
    each = F.explode(F.array(*[F.lit(s) for s in BASIC]))
    points = _p(spark, sf).select("pump_id", start.alias("time"), each.alias("signal"), F.lit(True).alias("detailed"))
    x = asof.asof_join(points, _r(spark, sf, detailed=True).select(*SERIES, "time", "value", "pos"))
    return x.select("pump_id", "signal", "time", F.col("reading.value").alias("value"), F.col("reading.time").alias("since"))


def q_format_time(spark, sf):
    r = _r(spark, sf)
    return r.select("pos", format_time_col(F.col("time").cast("string")).alias("api_time"))


def typed_time(pos, time):
    """Time texts as a client passes them, derived from each reading: full,
    with fraction, offset or Z, partial, basic and broken forms."""
    k = pos % 10
    full = F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss")
    day = F.date_format(time, "yyyy-MM-dd")
    return (
        F.when(k == 0, F.concat(full, F.lit("Z")))
        .when(k == 1, F.concat(full, F.lit(".123456")))
        .when(k == 2, F.concat(full, F.lit("+02:00")))
        .when(k == 3, day)
        .when(k == 4, F.date_format(time, "yyyyMMdd"))
        .when(k == 5, F.date_format(time, "yyyy-MM"))
        .when(k == 6, F.concat(F.lit(" "), full))
        .when(k == 7, F.concat(F.lit("foo"), F.lit("Z")))
        .when(k == 8, F.date_format(time, "yyyy-MM-dd HH:mm"))
        .otherwise(F.concat(F.date_format(time, "yyyy"), F.lit("-13-01T00:00:00")))
    )


def q_format_time_text(spark, sf):
    """F1 over the forms of :func:`typed_time`."""
    r = _r(spark, sf).select("pos", typed_time(F.col("pos"), F.col("time")).alias("k"))
    return r.select("pos", "k", format_time_col(F.col("k")).alias("api_time"))


def typed_hours(pos):
    """What a user might type for the hours of a lookback."""
    k = pos % 6
    n = (pos % 100).cast("string")
    return (
        F.when(k == 0, "")
        .when(k == 1, n)
        .when(k == 2, F.concat(F.lit(" "), n, F.lit("\t")))
        .when(k == 3, F.concat(n, F.lit(".5")))
        .when(k == 4, F.concat(n, F.lit("h")))
        .otherwise(F.concat(F.lit("+"), n))
    )


def q_lookback_range(spark, sf):
    """lookback hours as text, and the start they give."""
    r = _r(spark, sf).select("pos", typed_hours(F.col("pos")).alias("k"))
    h = lookback_hours(F.col("k"))
    return r.select("pos", "k", h.alias("hours"), lookback_start(h, NOW).alias("start_time"))


def range_keyword(pos, time):
    """What a user might type for a range, derived from each reading."""
    k = pos % 12
    d = F.date_format(time, "yyyy-MM-dd")
    return (
        F.when(k == 0, "")
        .when(k == 1, "hoy")
        .when(k == 2, "\tAyer \n")
        .when(k == 3, "week")
        .when(k == 4, "SEMANA")
        .when(k == 5, d)
        .when(k == 6, F.date_format(time, "yyyy-MM-dd HH:mm"))
        .when(k == 7, "nonsense")
        .when(k == 8, "yesterday")
        .when(k == 9, F.date_format(time, "yyyy-M-d H:m"))
        .when(k == 10, F.concat(d, F.lit("\n")))
        .otherwise(F.concat(d, F.lit("x")))
    )


def q_relative_range(spark, sf):
    r = _r(spark, sf).select("pos", range_keyword(F.col("pos"), F.col("time")).alias("k"))
    return r.select("pos", "k", range_start(F.col("k"), NOW).alias("start_time"), range_end(F.col("k"), NOW).alias("end_time"))


def _flat(df: DataFrame, keys, columns) -> DataFrame:
    """Readings of series columns again: ``keys, signal, time, value, pos``."""
    entries = F.array(*[F.struct(F.lit(s).alias("signal"), F.col(c).alias("series")) for c, s in columns.items()])
    x = df.select(*keys, F.explode(entries).alias("_e")).select(
        *keys, "_e.signal", F.explode("_e.series").alias("_r")
    )
    return x.select(*keys, "signal", "_r.time", "_r.value", "_r.pos")


def q_wide_record(spark, sf):
    """Every chunk of every pump's plain record, flattened; a pump
    without readings shows with nulls."""
    p = _p(spark, sf)
    w = reports.wide_record(p, _r(spark, sf, detailed=False))
    flat = _flat(w, ["pump_id"], {c: s for s, c in reports.WIDE_SIGNALS.items()})
    return p.select("pump_id", "name").join(flat, "pump_id", "left")


def q_wide_chunks(spark, sf):
    """The chunks themselves: number of readings by series and chunk."""
    w = reports.wide_record(_p(spark, sf), _r(spark, sf, detailed=True), detailed=True)
    return w.select(
        "pump_id", "chunk", *[safe_size(c).cast("long").alias(f"n_{c}") for c in reports.WIDE_SIGNALS.values()]
    )


def q_result_document(spark, sf):
    """K1: the documents of one bundle and range, written, read back by S9."""
    r = _r(spark, sf, start=RANGE[0], end=RANGE[1])
    docs = writers.result_documents(r, _p(spark, sf), "all_detailed", RANGE[0], RANGE[1], NOW)
    path = work_path(spark, "result-documents")
    writers.write_documents(docs, path)
    back = result_docs.read_result_docs(spark, path, multi_line=False)
    return back.select(F.col("pump_id").cast("long").alias("pump_id"), "name", "signal", "detailed", "time", "value")


def q_history_document(spark, sf):
    """K7: the history documents, flattened again."""
    docs = bundles.history_document(_r(spark, sf, detailed=True), RANGE[1], "48")
    x = docs.select("bomba_id", F.explode("datos").alias("signal", "series")).select(
        "bomba_id", "signal", F.explode("series").alias("_r")
    )
    return x.select(
        F.col("bomba_id").alias("pump_id"), "signal", reading_time(F.col("_r.time")).alias("time"), "_r.value"
    )


def q_latest_csv(spark, sf):
    """K3: the latest-value CSV, written and read back."""
    r = _r(spark, sf, signals=["status", "rawpower"], detailed=False)
    path = work_path(spark, "latest-csv")
    writers.write_csv(writers.latest_export(latest.latest_wide(_p(spark, sf), r), NOW), path)
    ddl = (
        "ID long, Nombre string, Timestamp timestamp_ntz, Estado_Disponible boolean, Potencia_Disponible boolean, "
        "Estado_Valor double, Estado_Tiempo timestamp_ntz, Potencia_Valor double, Potencia_Tiempo timestamp_ntz"
    )
    return spark.read.schema(ddl).option("header", True).csv(path)


def q_id_names_csv(spark, sf):
    """K4: the id/name CSV, written and read back; blanks at the ends and
    quotes of a name survive."""
    named = F.concat(F.lit(' "'), F.coalesce("name", F.lit("")), F.lit('", '))
    p = _p(spark, sf).withColumn("name", named)
    path = work_path(spark, "id-names-csv")
    writers.write_csv(catalog_ops.id_names(p), path)
    read = spark.read.schema("id long, name string").options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    return read.csv(path)


def q_report_json(spark, sf):
    """K5: the report's two outputs, written; the rows with the totals."""
    rows = reports.report_rows(_p(spark, sf), _r(spark, sf), _fault_over())
    path = work_path(spark, "report")
    writers.report_documents(reports.fleet_summary(rows), rows, path, NOW)
    per_pump = spark.read.schema(
        "id long, name string, has_faults boolean, status_available boolean, power_available boolean"
    ).json(f"{path}/resumen_por_bomba")
    total = spark.read.schema("total_bombas long, bombas_procesadas long, bombas_con_fallos long").json(f"{path}/summary")
    return per_pump.join(F.broadcast(total.withColumn("_one", F.lit(1))), F.lit(1) == F.col("_one")).drop("_one")


def payload_body(pos, props):
    """A body per reading covering the body-derived outcome classes."""
    k = pos % 11
    arr = F.concat(F.lit("["), props, F.lit("]"))
    return (
        F.when(k == 0, "")
        .when(k == 1, "[]")
        .when(k == 2, "{")
        .when(k == 3, props)
        .when(k == 4, F.concat(arr, F.lit(" "), arr))
        .when(k == 5, F.concat(arr, F.lit(","), arr))
        .when(k == 6, F.concat(props, props))
        .when(k == 7, F.concat(arr, F.lit("]")))
        .when(k == 8, F.concat(F.lit("["), props, F.lit(", 5, null, "), props, F.lit("]")))
        .when(k == 9, F.lit("null"))
        .otherwise(arr)
    )


def landed_events(spark, sf) -> DataFrame:
    """A landed fetch per event: every class of body and of transport."""
    k = F.col("event_id") % 7
    return dtab.table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("pump_id"),
        dtab.signal_of().alias("signal"),
        F.expr(dtab.DETAILED_SQL).alias("detailed"),
        F.col("ts").alias("fetched_at"),
        F.when(k == 3, 500).otherwise(200).alias("http_status"),
        F.when(k == 4, payloads.NO_PUMP).when(k == 5, payloads.NO_SIGNAL).when(k == 6, "timeout").alias("error"),
        F.encode(payload_body(F.col("event_id"), F.col("props")), "UTF-8").alias("body"),
    )


def q_payload_outcomes(spark, sf):
    out = payloads.fetch_outcomes(landed_events(spark, sf))
    return out.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def q_payload_sizes(spark, sf):
    """A1: points of list results and, apart from them, keys of object ones."""
    return payloads.payload_sizes(landed_events(spark, sf)).select(*SERIES, "points", "keys")


def q_payload_partial(spark, sf):
    """S3: elements and rejected elements per pump and series."""
    return payloads.payload_elements(landed_events(spark, sf)).select(*SERIES, "elements", "rejected")


def q_payload_readings(spark, sf):
    """S3 end to end: readings -> service payloads -> decoded readings."""
    landed = landing.landed_bodies(_r(spark, sf))
    return payloads.readings_from_landed(landed).select(*SERIES, "time", "value")


def q_ingest_twice(spark, sf):
    """Ingest of two overlapping ranges, one of them twice: the readings."""
    r = _r(spark, sf)
    first = landing.landed_bodies(scans.time_range(r, None, RANGE[1]))
    second = landing.landed_bodies(scans.time_range(r, RANGE[0], None))
    path = work_path(spark, "ingest")
    for landed in (first, second, first):
        ingest_payloads(landed, f"{path}/readings", f"{path}/outcomes")
    return scan_log(spark, f"{path}/readings").select(
        F.col("pump_id").cast("long").alias("pump_id"), "signal", "detailed", "time", "value"
    )


def landed_series(r: DataFrame) -> DataFrame:
    """A landed payload per reading: the reading, one of the same time with
    another value, and for every fifth one without a time."""
    at = F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    item = lambda t, v: F.struct(t.alias("time"), v.alias("value"), F.col("validity"))
    value = F.col("value")
    untimed = F.when(F.col("pos") % 5 == 0, F.array(item(F.lit(None).cast("string"), value)))
    items = F.concat(F.array(item(at, value), item(at, value + 1)), F.coalesce(untimed, F.array()))
    return r.select(
        F.col("pump_id").cast("string").alias("pump_id"), "signal", "detailed",
        F.col("time").alias("fetched_at"), F.lit(200).alias("http_status"),
        F.lit(None).cast("string").alias("error"), F.encode(F.to_json(items), "UTF-8").alias("body"),
    )


def q_ingest_lossless(spark, sf):
    """Ingest of payloads with equal and missing times in overlapping ranges,
    one of them twice, compacted in between: the readings."""
    r = _r(spark, sf)
    first, second = scans.time_range(r, None, RANGE[1]), scans.time_range(r, RANGE[0], None)
    path = work_path(spark, "ingest-log")
    for n, part in enumerate((first, second, first)):
        ingest_payloads(landed_series(part), f"{path}/readings", f"{path}/outcomes")
        if n == 1:
            compact(spark, f"{path}/readings")
    return scan_log(spark, f"{path}/readings").select(
        F.col("pump_id").cast("long").alias("pump_id"), "signal", "detailed", "time", "value", "pos"
    )


def q_catalog_scan(spark, sf):
    path = work_path(spark, "landing-catalog")
    landing.land_catalog(_p(spark, sf), path, per_file=1000, bom=True)
    recs = catalog.read_catalog(spark, path)
    return recs.select("pump_id", "name", F.size(F.col("links")).cast("long").alias("links"))


def q_result_docs(spark, sf):
    path = work_path(spark, "landing-docs")
    landing.land_result_docs(_r(spark, sf), _p(spark, sf), path)
    rd = result_docs.read_result_docs(spark, f"{path}/*", multi_line=False)
    return rd.select(*SERIES, "time", "value")


def q_bom_repair(spark, sf):
    src = work_path(spark, "landing-bom")
    landing.land_catalog(_p(spark, sf), f"{src}/with_bom", per_file=1000, bom=True)
    landing.land_catalog(_p(spark, sf), f"{src}/plain", per_file=1000, bom=False, envelope=True)
    status = bom.repair_bom(spark, src, work_path(spark, "repaired"), pattern="*.txt")
    # The text writer numbers the files; folder, status and whether a mark went are fixed.
    return status.groupBy(
        F.substring_index("file", "/", 1).alias("folder"),
        "status",
        (F.col("bytes_in") - F.col("bytes_out")).alias("bytes_dropped"),
    ).agg(F.count(F.lit(1)).alias("files"))


def _json_files(spark, files: DataFrame, kind: str, schema: str) -> DataFrame:
    """``files(file, content)`` written, and read back as ``file, doc``."""
    path = work_path(spark, kind)
    write_named_files(files, path, unique=True)
    back = read_named_files(spark, path)
    return back.select("file", F.from_json(F.decode("content", "UTF-8"), schema).alias("doc"))


def q_result_files(spark, sf):
    """A file per document part under its own name, bytes read back."""
    r = _r(spark, sf, signals=["status"], start=RANGE[0], end=RANGE[1], detailed=False)
    docs = writers.result_documents(r, _p(spark, sf), "status", RANGE[0], RANGE[1], NOW)
    item = READING_ARRAY_DDL
    back = _json_files(
        spark, writers.document_files(docs), "result-files",
        f"bomba struct<id:string,name:string>, endpoint string, datos {item}, timestamp_consulta string",
    )
    return back.select(
        "file",
        F.col("doc.bomba.name").alias("name"),
        F.col("doc.endpoint").alias("endpoint"),
        F.size("doc.datos").cast("long").alias("points"),
        F.array_max(F.transform("doc.datos", lambda x: x["value"])).alias("largest"),
        F.col("doc.timestamp_consulta").alias("stamp"),
    )


def q_wide_files(spark, sf):
    """K6: the wide record's documents as files of their own, read back."""
    wide = reports.wide_record(_p(spark, sf), _r(spark, sf, detailed=True), detailed=True)
    series = list(reports.WIDE_SIGNALS.values())
    back = _json_files(
        spark, writers.wide_record_files(wide, NOW), "wide-files",
        f"bomba_id long, timestamp timestamp_ntz, info struct<id:string,name:string>, "
        + ", ".join(f"{c} {READING_ARRAY_DDL}" for c in series),
    )
    return back.select(
        "file", F.col("doc.bomba_id").alias("pump_id"), F.col("doc.info.name").alias("name"),
        F.col("doc.timestamp").alias("timestamp"),
        *[F.size(f"doc.{c}").cast("long").alias(f"n_{c}") for c in series],
    )


def q_history_files(spark, sf):
    """K7: the history documents as files of their own, flattened again."""
    docs = bundles.history_document(_r(spark, sf, detailed=True), RANGE[1], "48")
    back = _json_files(
        spark, writers.history_files(docs), "history-files", f"bomba_id long, datos map<string,{READING_ARRAY_DDL}>"
    )
    x = back.select("file", "doc.bomba_id", F.explode("doc.datos").alias("signal", "series"))
    x = x.select("file", "bomba_id", "signal", F.explode("series").alias("_r"))
    return x.select(
        "file", F.col("bomba_id").alias("pump_id"), "signal", reading_time(F.col("_r.time")).alias("time"), "_r.value"
    )


def q_output_files(spark, sf):
    """K2/K9: readings of a range as CSV under the default stamped path, a
    folder per pump, with the stamp column; read back."""
    r = _r(spark, sf, signals=["speed"], start=RANGE[0], end=RANGE[1])
    path = writers.default_export_path(work_path(spark, "output"), NOW)
    writers.write_output(r.select("pump_id", "time", "value"), path, fmt="csv", separate_files=True, now=NOW)
    read = spark.read.schema("time timestamp_ntz, value double, fetched_at timestamp_ntz, pump_id long")
    with short_listing(spark):
        back = read.option("header", True).csv(path)
    name = F.regexp_extract(F.col("_metadata.file_path"), "/(fleet_data_[0-9_]+)/", 1)
    return back.select("pump_id", "time", "value", "fetched_at", name.alias("folder"))


def q_schedule_scan(spark, sf):
    """Control and flow-schedule series of a range (orders stand in for
    their readings)."""
    signal = F.expr("CASE o_orderstatus WHEN 'F' THEN 'aaecontrol' WHEN 'O' THEN 'flowschedule' ELSE 'onoffschedule' END")
    r = dtab.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("pump_id"), signal.alias("signal"), F.lit(False).alias("detailed"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("time"), F.col("o_totalprice").alias("value"),
        F.col("o_orderkey").alias("pos"),
    )
    start, end = dt.datetime(1995, 1, 1), dt.datetime(1996, 12, 31)
    x = scans.range_scan(r, signals=["aaecontrol", "flowschedule"], start=start, end=end)
    return x.select("pump_id", "signal", "time", "value", "pos")


def q_payload_flags(spark, sf):
    """§2.12: the three availability booleans, counted."""
    out = payloads.fetch_outcomes(landed_events(spark, sf))
    return out.groupBy("is_nonempty", "is_not_null", "is_not_empty_object").agg(F.count(F.lit(1)).alias("n"))


def q_bom_repair_bytes(spark, sf):
    """K8: repaired files by path below the input, with a hash of their bytes."""
    src, out = work_path(spark, "landing-bom"), work_path(spark, "repaired")
    p = _p(spark, sf)
    files = landing.catalog_files(p, "in/with_bom", bom=True).unionByName(
        landing.catalog_files(p, "in/plain/in", bom=False, envelope=True)
    )
    write_named_files(files, src, unique=True)
    bom.repair_bom(spark, src, out)
    return read_named_files(spark, out).select(
        "file", F.length("content").cast("long").alias("bytes"), F.sha2("content", 256).alias("sha256")
    )


def q_stream_latest(spark, sf):
    src = dtab.events_to_readings(dtab.events_stream(spark, sf))
    sink = monitors.run_available(spark, "latest", monitors.start_latest_monitor, src)
    return monitors.read_latest(spark, sink)


def q_stream_labels(spark, sf):
    """T1 with labels: readings to the 20th land, all series fall silent, the
    rest lands: those that speak again have a value, the others no data."""
    src, sink, ck = (work_path(spark, f"labels-{x}") for x in ("landing", "sink", "checkpoint"))
    events = dtab.table(spark, sf, "events")
    events.limit(0).write.parquet(src)
    stream = dtab.events_to_readings(spark.readStream.schema(events.schema).parquet(src))
    first = F.dayofmonth("ts") <= RANGE[1].day
    for part, silent_after in ((first, 0.05), (~first, 86400.0)):
        events.where(part).write.mode("append").parquet(src)
        monitors.stop_when_idle(monitors.start_label_monitor(stream, sink, ck, LABEL_TRIGGER, silent_after))
    silent = F.col("label") == NO_DATA
    return monitors.read_labels(spark, sink).select(*SERIES, "value", "time", silent.alias("silent"))


def q_stream_latest_files(spark, sf):
    """T1 on payload files: each pump's status readings land as a file, half
    of the pumps before the second run."""
    root = work_path(spark, "latest-files")
    src, sink, ck = f"{root}/landing", f"{root}/sink", f"{root}/checkpoint"
    files = landing.payload_files(_r(spark, sf, signals=["status"], detailed=False))
    odd = F.regexp_extract("file", "pump_id=([0-9]+)", 1).cast("long") % 2 == 1
    stream = None
    for part in (odd, ~odd):
        write_named_files(files.where(part), src, unique=True)
        stream = stream or monitors.landed_files_stream(spark, src)
        q = monitors.start_latest_monitor(stream, sink, ck, {"availableNow": True})
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    now = monitors.read_latest(spark, sink)
    return now.select(F.col("pump_id").cast("long").alias("pump_id"), "signal", "detailed", "value", "time")


def q_stream_heartbeat(spark, sf):
    src = dtab.events_to_readings(dtab.events_stream(spark, sf))
    sink = monitors.run_available(spark, "heartbeat", monitors.start_heartbeat, src, _p(spark, sf))
    return spark.read.parquet(sink).select("pump_id", "status", "power")


def q_stream_heartbeat_polls(spark, sf):
    """Six polls; five days of readings land before each, but none before
    the fourth, whose days land before the fifth."""
    src = work_path(spark, "heartbeat-landing")
    events = dtab.table(spark, sf, "events")
    day_slice = F.least(F.floor((F.dayofmonth("ts") - 1) / 5), F.lit(5))
    lands = F.when(day_slice == 3, 4).otherwise(day_slice)
    events.limit(0).write.parquet(src)
    stream = dtab.events_to_readings(spark.readStream.schema(events.schema).parquet(src))

    def land(n):
        if n != 3:
            events.where(lands == n).write.mode("append").parquet(src)

    sink, ck = work_path(spark, "heartbeat-sink"), work_path(spark, "heartbeat-checkpoint")
    polls = monitors.run_heartbeat(stream, _p(spark, sf), sink, ck, polls=6, every=0, before=land)
    return polls.select(F.col("poll").cast("long").alias("poll"), "pump_id", "status", "power")


def q_stream_fault_alerts(spark, sf):
    src = dtab.events_to_readings(dtab.events_stream(spark, sf))
    chosen = catalog_ops.name_filter(_p(spark, sf), ["0001", "77"])
    sink = monitors.run_available(spark, "alerts", monitors.start_fault_alerts, src, chosen)
    return monitors.read_alerts(spark, sink).select("pump_id", "name", "time", "value")


QUERIES = {
    "range_scan": q_range_scan,
    "range_scan_open": q_range_scan_open,
    "range_carry_in": q_range_carry_in,
    "range_carry_in_indexed": q_range_carry_in_indexed,
    "latest_indexed": q_latest_indexed,
    "signal_select": q_signal_select,
    "detailed_select": q_detailed_select,
    "signal_counts": q_signal_counts,
    "individual_query": q_individual_query,
    "latest_per_signal": q_latest_per_signal,
    "latest_wide": q_latest_wide,
    "report_rows": q_report_rows,
    "fleet_report": q_fleet_report,
    "exclude_offline": q_exclude_offline,
    "fault_alerts": q_fault_alerts,
    "name_filter": q_name_filter,
    "id_names": q_id_names,
    "valid_ids": q_valid_ids,
    "head_n": q_head_n,
    "dedupe_last": q_dedupe_last,
    "links_workset": q_links_workset,
    "links_count": q_links_count,
    "links_rewrite": q_links_rewrite,
    "pump_info": q_pump_info,
    "file_key": q_file_key,
    "series_sample": q_series_sample,
    "history_export": q_history_export,
    "catalog_fallback": q_catalog_fallback,
    "catalog_fallback_files": q_catalog_fallback_files,
    "state_at_fault": q_state_at_fault,
    "in_force_per_pump": q_in_force_per_pump,
    "format_time": q_format_time,
    "format_time_text": q_format_time_text,
    "lookback_range": q_lookback_range,
    "relative_range": q_relative_range,
    "wide_record": q_wide_record,
    "wide_chunks": q_wide_chunks,
    "history_document": q_history_document,
    "latest_csv": q_latest_csv,
    "id_names_csv": q_id_names_csv,
    "report_json": q_report_json,
    "payload_partial": q_payload_partial,
    "payload_sizes": q_payload_sizes,
    "ingest_twice": q_ingest_twice,
    "ingest_lossless": q_ingest_lossless,
    "link_lookup": q_link_lookup,
    "result_document": q_result_document,
    "payload_outcomes": q_payload_outcomes,
    "payload_readings": q_payload_readings,
    "catalog_scan": q_catalog_scan,
    "result_docs": q_result_docs,
    "bom_repair": q_bom_repair,
    "bom_repair_bytes": q_bom_repair_bytes,
    "result_files": q_result_files,
    "wide_files": q_wide_files,
    "history_files": q_history_files,
    "output_files": q_output_files,
    "schedule_scan": q_schedule_scan,
    "payload_flags": q_payload_flags,
    "stream_latest": q_stream_latest,
    "stream_labels": q_stream_labels,
    "stream_latest_files": q_stream_latest_files,
    "stream_heartbeat": q_stream_heartbeat,
    "stream_heartbeat_polls": q_stream_heartbeat_polls,
    "stream_fault_alerts": q_stream_fault_alerts,
}
