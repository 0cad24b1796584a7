""""Last reading by (time, pos)" as one aggregate expression.

``max_by(struct(fields), struct(time, pos))``: exact (position breaks ties
in time; a null time ranks lowest) and partially aggregated on every map
task, so the shuffle carries one row per key per task however skewed the
keys are. Spark plans it as a sort-based aggregate because struct buffers
are not fixed-width. Measured at 1M readings on local[8] (added time over a
plain grouped count): struct key 0.19 s, a window ``row_number() = 1``
0.25 s, a ``DECIMAL(38,0)`` packed key on the hash aggregate 0.39 s (its
buffer is re-serialised on every update), so the struct key is used.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def order_key(time: str = "time", pos: str = "pos") -> Column:
    """Ordering of readings: by ``time``, then position in the payload."""
    return F.struct(F.col(time).alias("time"), F.col(pos).alias("pos"))


def last_of(fields, where: Column | None = None, time: str = "time", pos: str = "pos") -> Column:
    """Aggregate: ``struct(fields)`` of the last row (optionally among rows
    matching ``where``); null when no row qualifies."""
    key = order_key(time, pos)
    if where is not None:
        key = F.when(where, key)
    return F.max_by(F.struct(*[F.col(f) for f in fields]), key)
