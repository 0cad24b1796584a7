"""Labels of series that may fall silent: keyed state with timers.

Per series (pump, signal, detailed) the state holds the latest reading and
whether the series is shown as silent. Every contact sets a timer; when it
runs out, the "no data" label is emitted, without any input. The state expires
on its own when a series is gone for long.

A hot series does not travel whole: each task first keeps the latest reading
of every series of an Arrow batch, so the shuffle and the keyed step see few
rows per series.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sigfleet.schemas import NO_DATA

# The processor travels to the Python workers whole: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORGET_AFTER = 30 * 86400.0  # seconds
SERIES = ["pump_id", "signal", "detailed"]
LATEST_DDL = "time timestamp_ntz, pos long, value double, silent boolean"


def _later(a, b) -> bool:
    """Whether reading ``a`` is later than ``b`` by (time, pos); a missing time
    or position ranks lowest, as in the batch aggregate."""
    for x, y in zip(a, b, strict=True):
        if x != y:
            return y is None if x is None or y is None else x > y
    return False


class SilenceProcessor(StatefulProcessor):
    """Emits ``label, value, time`` of a series when its latest reading changes,
    when it falls silent and when it speaks again."""

    def __init__(self, silent_ms: int, forget_ms: int, no_data: str):
        self.silent_ms, self.forget_ms, self.no_data = silent_ms, forget_ms, no_data

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.latest = handle.getValueState("latest", LATEST_DDL, ttlDurationMs=self.forget_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        old = self.latest.get()
        best = tuple(old[:3]) if old is not None else None
        for r in rows:
            new = (r.time, r.pos, r.value)
            if best is None or _later(new[:2], best[:2]):
                best = new
        # No timer waits for a silent series, nor for one that the state does not have.
        self._wait(timerValues, fresh=old[3] if old is not None else self.forget_ms > self.silent_ms)
        self.latest.update((*best, False))
        if old is None or old[3] or _later(best[:2], old[:2]):
            label = self.no_data if best[2] is None else str(best[2])
            yield self._shown(key, label, best)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        old = self.latest.get()
        if old is not None and not old[3]:
            self.latest.update((*old[:3], True))
            yield self._shown(key, self.no_data, old)

    def _shown(self, key, label: str, reading) -> Row:
        return Row(**dict(zip(SERIES, key, strict=True)), label=label, value=reading[2], time=reading[0])

    def _wait(self, timerValues, fresh: bool) -> None:
        """One timer per series, from this contact on; every call asks the JVM."""
        for t in () if fresh else list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.silent_ms)

    def close(self) -> None:
        pass


def latest_of_batches(readings: DataFrame) -> DataFrame:
    """The latest reading of each series in every Arrow batch of a task."""
    names = [*SERIES, "time", "pos", "value"]

    def keep(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            t = pa.table(batch)
            order = pc.sort_indices(t, [("time", "ascending"), ("pos", "ascending")], null_placement="at_start")
            t = t.take(order)
            place = t.append_column("_place", pa.array(range(t.num_rows), pa.int64()))
            last = place.group_by(SERIES).aggregate([("_place", "max")])["_place_max"]
            yield from t.take(last).to_batches()

    kept = readings.select(*names)
    return kept.mapInArrow(keep, kept.schema)


def labels_stream(readings: DataFrame, silent_after: float, forget_after: float = FORGET_AFTER) -> DataFrame:
    """``pump_id, signal, detailed, label, value, time``: changes of the labels.

    Readings without a value show the label; a null pump or signal is a series
    of its own.
    """
    key = {f.name: f.dataType.simpleString() for f in readings.schema if f.name in SERIES}
    ddl = ", ".join([*(f"{c} {key[c]}" for c in SERIES), "label string", "value double", "time timestamp_ntz"])
    processor = SilenceProcessor(int(silent_after * 1000), int(forget_after * 1000), NO_DATA)
    return (
        latest_of_batches(readings)
        .groupBy(*[F.col(c) for c in SERIES])
        .transformWithState(processor, outputStructType=ddl, outputMode="Update", timeMode="ProcessingTime")
    )
