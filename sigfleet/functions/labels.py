"""Labels, defaults and file keys (P8-P10, F11, F12) as Column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sigfleet.schemas import FILE_STAMP_FORMAT, NO_DATA, NO_NAME, POINTS_SUFFIX, RESULT_FILE_PREFIX
from sigfleet.functions.timefmt import ntz


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def default_name(name) -> Column:
    """Missing name -> the "no name" label. (JSON null counts as missing.)"""
    return F.coalesce(_col(name), F.lit(NO_NAME))


def utc_now() -> Column:
    """The clock as UTC wall clock, whatever the session zone."""
    return F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast("timestamp_ntz")


def file_stamp(now=None) -> Column:
    """``yyyyMMdd_HHmmss`` of ``now`` (the job argument) or of the clock."""
    t = utc_now() if now is None else ntz(now)
    return F.date_format(t, FILE_STAMP_FORMAT)


def file_key(endpoint, name, now=None, blank: str = " ") -> Column:
    """``consulta_{endpoint}_{name, blank -> _}_{stamp}``."""
    e = F.lit(endpoint) if isinstance(endpoint, str) else endpoint
    clean = F.replace(default_name(name), F.lit(blank), F.lit("_"))
    return F.concat_ws("_", F.lit(RESULT_FILE_PREFIX), e, clean, file_stamp(now))


def points_label(n) -> Column:
    """P10: ``N puntos`` when there is data, otherwise the "no data" label."""
    c = _col(n)
    return F.when(c > 0, F.concat(c.cast("string"), F.lit(POINTS_SUFFIX))).otherwise(F.lit(NO_DATA))


def safe_size(arr) -> Column:
    """length with truthiness: null -> 0."""
    return F.coalesce(F.size(_col(arr)), F.lit(0))
