"""Command line: the client's questions as batch jobs over whole tables.

    python -m sigfleet query   --readings R --pumps P --endpoint all_basic \\
                               [--pump ID ...] [--start hoy] [--end ""] --out DIR
    python -m sigfleet latest  --readings R --pumps P --out DIR
    python -m sigfleet report  --readings R --pumps P --out DIR [--faults-from OUTCOMES]
    python -m sigfleet history --readings R --pumps P [--pump ID ...] [--hours 24] --out DIR
    python -m sigfleet ingest-payloads --landed DIR --readings R --outcomes O
    python -m sigfleet compact --readings R
    python -m sigfleet ingest-catalog  --catalog DIR --pumps P --links L
    python -m sigfleet repair-bom --input DIR --output DIR [--pattern '*.json']
    python -m sigfleet monitor --landing DIR --sink DIR --checkpoint DIR [--once] [--landed]
                               [--kind latest|heartbeat|alerts] [--pumps P] [--pump ID ...]

``R`` is a readings table written by ``ingest-payloads``; ``P`` a pumps
table from ``ingest-catalog``. Range texts follow the client's rules
(keywords, ``yyyy-MM-dd``, ``yyyy-MM-dd HH:mm``); ``--now`` fixes the clock.
Omitting ``--pump`` asks for the whole fleet.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import functions as F

from sigfleet.functions.timefmt import lookback_number, range_end, range_start
from sigfleet.operators import bundles, latest, reports, scans
from sigfleet.plans.ingest import ingest_catalog, ingest_payloads
from sigfleet.schemas import ENDPOINTS, READINGS_SCHEMA
from sigfleet.session import build_session
from sigfleet.sinks import bom, writers
from sigfleet.sources.payloads import read_landed_files
from sigfleet.sources.readings_log import compact, runs, scan_log
from sigfleet.sources.readings_table import scan_readings
from sigfleet.streaming import monitors


def _now(args) -> dt.datetime:
    return dt.datetime.fromisoformat(args.now) if args.now else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)


def _range(spark, start_text: str, end_text: str, now: dt.datetime):
    """Evaluate the range rules once (one-row frame); a rejected text raises."""
    row = spark.range(1).select(
        range_start(F.lit(start_text), now).alias("s"), range_end(F.lit(end_text), now).alias("e")
    ).first()
    if row.s is None:
        raise SystemExit(f"invalid start: {start_text!r}")
    if row.e is None:
        raise SystemExit(f"invalid end: {end_text!r}")
    return row.s, row.e


def _pumps(spark, args):
    p = spark.read.parquet(args.pumps)
    return p.where(F.col("pump_id").isin(args.pump)) if args.pump else p


def _readings(spark, args, **scope):
    """The readings in scope: of the append log, or of a plain table."""
    scan = scan_log if runs(spark, args.readings) else scan_readings
    return scan(spark, args.readings, **scope)


def cmd_compact(spark, args):
    compact(spark, args.readings)


def cmd_query(spark, args):
    if args.endpoint not in ENDPOINTS:
        raise SystemExit(f"endpoint not implemented: {args.endpoint}")
    now = _now(args)
    start, end = _range(spark, args.start, args.end, now)
    signals, detailed = ENDPOINTS[args.endpoint]
    r = _readings(spark, args, signals=signals, pump_ids=args.pump, start=start, end=end)
    r = r.where(F.col("detailed") == F.lit(detailed))
    docs = writers.result_documents(r, _pumps(spark, args), args.endpoint, start, end, now)
    writers.write_documents(docs, args.out)
    for row in bundles.signal_counts(r, signals).collect():  # at most 4 rows
        print(json.dumps({"signal": row.signal, "points": row.points, "label": row.label}))


def cmd_latest(spark, args):
    r = _readings(spark, args, signals=["status", "rawpower"])
    writers.write_csv(writers.latest_export(latest.latest_wide(_pumps(spark, args), r), _now(args)), args.out)


def cmd_report(spark, args):
    pumps = _pumps(spark, args)
    if args.faults_from:
        rows = reports.outcome_report_rows(pumps, spark.read.parquet(args.faults_from))
    else:
        rows = reports.report_rows(pumps, _readings(spark, args))
    writers.report_documents(reports.fleet_summary(rows), rows, args.out, _now(args))


def cmd_history(spark, args):
    now = _now(args)
    start = now - dt.timedelta(hours=lookback_number(args.hours))
    r = _readings(spark, args, pump_ids=args.pump, start=start, end=now)
    doc = bundles.history_document(r, now, args.hours)
    doc.write.mode("overwrite").json(args.out)


def cmd_ingest_payloads(spark, args):
    landed = read_landed_files(spark, args.landed, pump_id="pump_id", signal="signal")
    ingest_payloads(landed, args.readings, args.outcomes)


def cmd_ingest_catalog(spark, args):
    ingest_catalog(spark, args.catalog, args.pumps, args.links)


def cmd_repair_bom(spark, args):
    status = bom.repair_bom(spark, args.input, args.output, args.pattern)
    for row in status.groupBy("status").count().collect():  # at most 3 rows
        print(json.dumps({"status": row["status"], "files": row["count"]}))


def cmd_monitor(spark, args):
    if args.landed:
        stream = monitors.landed_readings_stream(spark, args.landing)
    else:
        stream = spark.readStream.schema(READINGS_SCHEMA).parquet(args.landing)
    trigger = {"availableNow": True} if args.once else {"processingTime": f"{args.every} seconds"}
    if args.kind == "latest":
        q = monitors.start_latest_monitor(stream, args.sink, args.checkpoint, trigger)
    else:
        if not args.pumps:
            raise SystemExit(f"monitor --kind {args.kind} needs --pumps")
        start = monitors.start_heartbeat if args.kind == "heartbeat" else monitors.start_fault_alerts
        q = start(stream, _pumps(spark, args), args.sink, args.checkpoint, trigger)
    q.awaitTermination()


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="sigfleet")
    ap.add_argument("--master", default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)

    def common(p, readings=True, pumps=True):
        if readings:
            p.add_argument("--readings", required=True)
        if pumps:
            p.add_argument("--pumps", required=True)
        p.add_argument("--pump", nargs="*", default=None)
        p.add_argument("--now", default=None)
        p.add_argument("--out", required=True)

    q = sub.add_parser("query")
    common(q)
    q.add_argument("--endpoint", required=True)
    q.add_argument("--start", default="")
    q.add_argument("--end", default="")
    common(sub.add_parser("latest"))
    r = sub.add_parser("report")
    common(r)
    r.add_argument("--faults-from", default=None)
    h = sub.add_parser("history")
    common(h, pumps=False)
    h.add_argument("--hours", default="24")
    ip = sub.add_parser("ingest-payloads")
    ip.add_argument("--landed", required=True)
    ip.add_argument("--readings", required=True)
    ip.add_argument("--outcomes", required=True)
    sub.add_parser("compact").add_argument("--readings", required=True)
    ic = sub.add_parser("ingest-catalog")
    ic.add_argument("--catalog", required=True)
    ic.add_argument("--pumps", required=True)
    ic.add_argument("--links", required=True)
    rb = sub.add_parser("repair-bom")
    rb.add_argument("--input", required=True)
    rb.add_argument("--output", required=True)
    rb.add_argument("--pattern", default="*.json")
    m = sub.add_parser("monitor")
    m.add_argument("--landing", required=True)
    m.add_argument("--sink", required=True)
    m.add_argument("--checkpoint", required=True)
    m.add_argument("--every", type=int, default=30)
    m.add_argument("--kind", choices=["latest", "heartbeat", "alerts"], default="latest")
    m.add_argument("--landed", action="store_true", help="the landing holds payload rows, not readings")
    m.add_argument("--pumps", default=None)
    m.add_argument("--pump", nargs="*", default=None)
    m.add_argument("--once", action="store_true")
    return ap


COMMANDS = {
    "query": cmd_query,
    "latest": cmd_latest,
    "report": cmd_report,
    "history": cmd_history,
    "ingest-payloads": cmd_ingest_payloads,
    "compact": cmd_compact,
    "ingest-catalog": cmd_ingest_catalog,
    "repair-bom": cmd_repair_bom,
    "monitor": cmd_monitor,
}


def main(argv=None, spark=None) -> None:
    args = parser().parse_args(argv)
    spark = spark or build_session(master=args.master)
    COMMANDS[args.cmd](spark, args)


if __name__ == "__main__":
    main(sys.argv[1:])
