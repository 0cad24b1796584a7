"""Groups of rows inside ``mapInArrow``, streamed.

``grouped`` deals rows by key columns and sorts each partition by them, so a
group arrives as consecutive rows; one Python call handles a partition, not a
group, which keeps millions of small groups cheap. A group is held in memory
whole: callers bound its size by their choice of keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

Batches = Iterable[pa.RecordBatch]


def _boundaries(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """Row numbers, other than 0, at which a new group starts."""
    new = np.zeros(max(0, batch.num_rows - 1), bool)
    for k in keys:
        col = batch.column(k).to_numpy(zero_copy_only=False)
        new |= col[1:] != col[:-1]
    return np.flatnonzero(new) + 1


def stream(batches: Batches, keys: list[str]) -> Iterator[pa.Table]:
    """The groups of sorted batches, one table each (whole numbers as keys)."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cuts = [0, *_boundaries(batch, keys).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            part = batch.slice(a, b - a)
            key = tuple(part.column(k)[0].as_py() for k in keys) if a == 0 else None
            if held and (a or key != last):
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
        last = tuple(part.column(k)[0].as_py() for k in keys)
    if held:
        yield pa.Table.from_batches(held)


def grouped(
    df: DataFrame,
    keys: list[str],
    handle: Callable[[Iterator[pa.Table]], Iterator[pa.RecordBatch]],
    schema: str,
    order: list[str] = (),
) -> DataFrame:
    """``handle`` over the groups of each partition of ``df``."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        yield from handle(stream(batches, keys))

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)
