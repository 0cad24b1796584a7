"""Connected components of a table of links: contraction and alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigfleet.llm.common import stored

# Links that one task contracts.
PER_TASK = 500_000


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star step over ``a > b`` links.

    Large: every node's larger neighbours link to its smallest neighbour (or
    itself). Small: its smaller neighbours and the node itself do.
    """
    near = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        near = near.unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    if not large:
        near = near.unionByName(near.select("u", F.col("u").alias("v")).distinct())
    out = near.join(least, "u")
    if large:
        out = out.where("v > u")
    out = out.where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return out if large else out.distinct()


def contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links ``a, b`` as stars: every node that is not the smallest of its
    part of these links, and that smallest."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while x != up[x]:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for batch in batches:
        for x, y in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            x, y = root(up.setdefault(x, x)), root(up.setdefault(y, y))
            if x != y:
                up[max(x, y)] = min(x, y)
    stars = [(x, r) for x in up if (r := root(x)) != x]
    for i in range(0, len(stars), 100_000):
        a, b = zip(*stars[i : i + 100_000], strict=True)
        yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def components(spark: SparkSession, links: DataFrame, max_steps: int = 60) -> DataFrame:
    """``id, component`` (smallest id) of every node that has a link.

    ``links`` has whole-number columns ``a`` and ``b``. The links are dealt to
    tasks of ``PER_TASK`` at most, each of which contracts its own to stars
    without a shuffle. One task's stars are the components; of several, star
    steps bring neighbours together and the round repeats until nothing
    changes (logarithmic in the longest chain).
    """
    now = stored(
        spark,
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")),
        "links",
    )
    state = F.struct(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s"))
    seen = None
    for _ in range(max_steps):
        new = now.select(state.alias("x")).first()["x"]
        if not new["n"] or new == seen:
            break
        seen = new
        tasks = -(-new["n"] // PER_TASK)
        now = stored(spark, now.coalesce(tasks).mapInArrow(contracted, "a long, b long"), "links")
        if tasks == 1:
            break
        now = stored(spark, _star(_star(now, True), False), "links")
    else:
        raise RuntimeError(f"links not resolved after {max_steps} steps")
    # Stars by now: every node links straight to the smallest of its component.
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )
