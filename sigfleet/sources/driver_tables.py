"""Adapter from the driver's parquet tables to the canonical tables.

``customer`` stands in for the pump catalogue and ``events`` for readings:

* ``c_custkey`` -> ``pump_id``, ``c_name`` -> ``name``
* ``user_id`` -> ``pump_id``, ``event_type`` -> ``signal`` (map below),
  ``ts`` -> ``time``, ``value`` -> ``value``, ``props.k`` -> ``validity``,
  ``event_id`` -> ``pos``; every fourth event (``event_id % 4 = 3``) belongs
  to the detailed series of its signal.

Signal predicates are translated back into ``event_type`` predicates
*before* the rename, so they reach the Parquet scan as pushed filters
(a predicate on a CASE-derived column is not pushed by Catalyst).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Adapter map (ours): event type -> signal; any other type is "inservice".
EVENT_SIGNAL = {
    "view": "status",
    "click": "rawpower",
    "purchase": "speed",
    "error": "fault",
}
FALLBACK_SIGNAL = "inservice"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


# The adapter map as one SQL CASE (built once; one expression per query).
SIGNAL_SQL = (
    "CASE event_type "
    + " ".join(f"WHEN '{et}' THEN '{sig}'" for et, sig in EVENT_SIGNAL.items())
    + f" ELSE '{FALLBACK_SIGNAL}' END"
)


def signal_of(event_type: Column | None = None) -> Column:
    """Signal of an event type (column ``event_type`` by default)."""
    if event_type is None:
        return F.expr(SIGNAL_SQL)
    expr = None
    for et, sig in EVENT_SIGNAL.items():
        expr = F.when(event_type == et, sig) if expr is None else expr.when(event_type == et, sig)
    return expr.otherwise(FALLBACK_SIGNAL)


def event_type_sql(signals) -> str | None:
    """SQL predicate on ``event_type`` equal to ``signal IN signals``."""
    if signals is None:
        return None
    signals = set(signals)
    known = [e for e, s in EVENT_SIGNAL.items() if s in signals]
    pred = f"event_type IN ({_sql_list(known)})" if known else "false"
    if FALLBACK_SIGNAL in signals:
        pred = f"({pred} OR event_type IS NULL OR event_type NOT IN ({_sql_list(EVENT_SIGNAL)}))"
    return pred


def event_type_predicate(signals) -> Column | None:
    """``event_type`` predicate equal to ``signal IN signals``."""
    sql = event_type_sql(signals)
    return None if sql is None else F.expr(sql)


DETAILED_SQL = "event_id % 4 = 3"


def _ts_sql(t) -> str:
    return "TIMESTAMP_NTZ '" + t.isoformat(sep=" ") + "'"


def readings(
    spark: SparkSession,
    sf_dir: str,
    signals=None,
    pump_ids=None,
    start=None,
    end=None,
    detailed: bool | None = None,
) -> DataFrame:
    """Canonical readings ``(pump_id, signal, detailed, time, value, validity, pos)``.

    Every argument becomes one conjunct of a single filter on source
    columns, pushed to Parquet. ``start``/``end`` (datetimes) are inclusive;
    ``None`` leaves that side open.
    """
    ev = table(spark, sf_dir, "events")
    conds = []
    if signals is not None:
        conds.append(event_type_sql(signals))
    if pump_ids is not None:
        conds.append(f"user_id IN ({', '.join(str(int(p)) for p in pump_ids)})")
    if start is not None:
        conds.append(f"ts >= {_ts_sql(start)}")
    if end is not None:
        conds.append(f"ts <= {_ts_sql(end)}")
    if detailed is not None:
        conds.append(DETAILED_SQL if detailed else f"NOT {DETAILED_SQL}")
    if conds:
        ev = ev.where(" AND ".join(f"({c})" for c in conds))
    return events_to_readings(ev)


READINGS_SQL = [
    "user_id AS pump_id",
    f"{SIGNAL_SQL} AS signal",
    f"({DETAILED_SQL}) AS detailed",
    "ts AS time",
    "value",
    "try_cast(get_json_object(props, '$.k') AS INT) AS validity",
    "event_id AS pos",
]


def events_to_readings(ev: DataFrame) -> DataFrame:
    """Projection ``events`` -> canonical readings (batch or streaming)."""
    return ev.selectExpr(*READINGS_SQL)


def events_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    """``events`` as a file stream (the folder, filtered to the events file)."""
    schema = table(spark, sf_dir, "events").schema
    rs = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    if max_files:
        rs = rs.option("maxFilesPerTrigger", max_files)
    return rs.parquet(sf_dir.rstrip("/"))


def pumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical catalogue ``(pump_id, name, source_pos)``; order = key order.

    Every tenth pump is taken to have no name in the catalogue.
    """
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("pump_id"),
        F.when(F.col("c_custkey") % 10 != 0, F.col("c_name")).alias("name"),
        F.col("c_custkey").alias("source_pos"),
    )
