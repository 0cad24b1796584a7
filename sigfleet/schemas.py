"""Canonical schemas and the fixed vocabulary of the telemetry service.

Everything under "Fixed values" must stay equal to what the upstream
service and its client use, otherwise links, labels and file names stop
matching. Everything else is ours.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (service vocabulary; keep as is)
# ---------------------------------------------------------------------------

# The eight signal codes a pump exposes, each plain and "/detailed".
SIGNAL_CODES = (
    "status",
    "rawpower",
    "speed",
    "fault",
    "aaecontrol",
    "inservice",
    "onoffschedule",
    "flowschedule",
)
DETAILED_SUFFIX = "/detailed"

# URL template of one signal of one pump; "{bmb_id}" is the pump id.
PUMPS_PATH = "/physicalPumps"
PUBLICATION_PATH = "/publication/physicalPumps"
SIGNAL_TEMPLATE = "/physicalPumps/{bmb_id}/{signal}/"
DETAILED_SIGNAL_TEMPLATE = "/physicalPumps/{bmb_id}/{signal}/detailed/"

# Menu endpoint names -> (signal codes, detailed).
ENDPOINTS = {
    "status": (("status",), False),
    "detailed_status": (("status",), True),
    "power": (("rawpower",), False),
    "detailed_power": (("rawpower",), True),
    "speed": (("speed",), False),
    "detailed_speed": (("speed",), True),
    "faults": (("fault",), False),
    "detailed_faults": (("fault",), True),
    "control": (("aaecontrol",), False),
    "detailed_control": (("aaecontrol",), True),
    "inservice": (("inservice",), False),
    "detailed_inservice": (("inservice",), True),
    "onoffschedule": (("onoffschedule",), False),
    "detailed_onoffschedule": (("onoffschedule",), True),
    "all_basic": (("status", "rawpower", "speed"), False),
    "all_detailed": (("status", "rawpower", "speed"), True),
}

# Signals of the lookback history document (all detailed) and its default hours.
HISTORY_SIGNALS = ("status", "rawpower", "speed", "fault")
HISTORY_DEFAULT_HOURS = 24

# Labels.
NO_NAME = "Sin nombre"
DEFAULT_PUMP_TYPE = "Physical Pump"
POINTS_SUFFIX = " puntos"
NO_DATA = "sin datos"
TOTAL_LABEL = "TOTAL"

# Range keywords (case-blind, trimmed) -> days back from "now".
RANGE_KEYWORDS = {
    "": 1,
    "hoy": 1,
    "today": 1,
    "ayer": 2,
    "yesterday": 2,
    "semana": 7,
    "week": 7,
}

# Wire format of times sent to the service and of result-file stamps.
API_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
FILE_STAMP_FORMAT = "yyyyMMdd_HHmmss"
RESULT_FILE_PREFIX = "consulta"
WIDE_FILE_PREFIX = "datos_detallados"
HISTORY_FILE_PREFIX = "historicos_bomba"

# Byte-order mark found in front of catalogue files and payloads.
BOM = "\ufeff"
BOM_BYTES = b"\xef\xbb\xbf"

# ---------------------------------------------------------------------------
# Our own choices
# ---------------------------------------------------------------------------

PLACEHOLDER_BASE_URL = "https://example.invalid"
DEFAULT_EXPORT_PREFIX = "fleet_data"

# Outcome classes of one fetch (kept apart instead of collapsing to [] / {}).
OUTCOMES = ("ok", "empty", "malformed", "object", "error", "no_pump", "no_signal")


def link_keys(detailed: bool | None = None) -> list[str]:
    """Catalogue link keys: ``code`` and/or ``code/detailed``."""
    plain = list(SIGNAL_CODES)
    det = [c + DETAILED_SUFFIX for c in SIGNAL_CODES]
    if detailed is None:
        return plain + det
    return det if detailed else plain


READING_STRUCT = T.StructType(
    [
        T.StructField("time", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("validity", T.IntegerType()),
    ]
)
READING_ARRAY_DDL = "array<struct<time:string,value:double,validity:int>>"

READINGS_SCHEMA = T.StructType(
    [
        T.StructField("pump_id", T.StringType()),
        T.StructField("signal", T.StringType()),
        T.StructField("detailed", T.BooleanType()),
        T.StructField("time", T.TimestampNTZType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("validity", T.IntegerType()),
        T.StructField("pos", T.LongType()),
    ]
)

LANDED_SCHEMA = T.StructType(
    [
        T.StructField("pump_id", T.StringType()),
        T.StructField("signal", T.StringType()),
        T.StructField("detailed", T.BooleanType()),
        T.StructField("fetched_at", T.TimestampNTZType()),
        T.StructField("http_status", T.IntegerType()),
        T.StructField("error", T.StringType()),
        T.StructField("body", T.BinaryType()),
    ]
)

RESULT_DOC_SCHEMA = T.StructType(
    [
        T.StructField(
            "bomba",
            T.StructType(
                [T.StructField("id", T.StringType()), T.StructField("name", T.StringType())]
            ),
        ),
        T.StructField("endpoint", T.StringType()),
        T.StructField(
            "rango",
            T.StructType(
                [T.StructField("inicio", T.StringType()), T.StructField("fin", T.StringType())]
            ),
        ),
        T.StructField("datos", T.StringType()),
        T.StructField("timestamp_consulta", T.StringType()),
    ]
)
