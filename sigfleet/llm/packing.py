"""Conflict-constrained best-fit packing of documents into bins.

Documents are cut into pieces of at most ``capacity`` words; full pieces fill
a bin alone. The other pieces of a shard are placed in order of falling size,
each into the bin with the smallest residual that still takes it and that is
compatible: a bin carries a bitmap of the duplicate clusters it holds and a
bitmap of the sources that have reached ``max_per_source``; bins are kept by
residual, and the search goes from one residual to its successor until a bin
agrees with both bitmaps. If none does, a new bin is opened.

Shards hold about ``SHARD_ROWS`` pieces dealt by hash, so a hot source or
cluster is spread evenly; only sizes and keys are shuffled, never texts.

Defined cases: a null or blank text has no words, takes no room and has a
null bin; a null source is a source of its own; repeated rows are packed each
for itself and, as one cluster, never share a bin; pieces of one document
never share a bin either, as they are one cluster.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sigfleet.llm.common import stored, text_key, word_array
from sigfleet.llm.groups import grouped

SHARD_ROWS = 8_192
CAPACITY = 4_096
MAX_PER_SOURCE = 4


class Shard:
    """Bins of one shard, ordered by residual."""

    def __init__(self, capacity: int, max_per_source: int) -> None:
        self.capacity, self.max_per_source = capacity, max_per_source
        self.residuals: list[int] = []
        self.clusters: list[int] = []
        self.saturated: list[int] = []
        self.counts: list[dict[int, int]] = []
        self.by_residual: dict[int, list[int]] = {}
        self.occupied = 0  # bit r: some bin has residual r

    def _move(self, b: int, residual: int) -> None:
        old = self.residuals[b]
        at = self.by_residual[old]
        at.remove(b)
        if not at:
            self.occupied &= ~(1 << old)
        self._enter(b, residual)

    def _enter(self, b: int, residual: int) -> None:
        self.residuals[b] = residual
        if residual:  # a full bin takes nothing more
            self.by_residual.setdefault(residual, []).append(b)
            self.occupied |= 1 << residual

    def place(self, size: int, source: int, cluster: int) -> int:
        """The bin of a piece; ``cluster`` is a bit mask, ``source`` a number."""
        source_bit = 1 << source
        r = size
        while True:
            rest = self.occupied >> r
            if not rest:
                break
            r += (rest & -rest).bit_length() - 1  # the next residual in use
            for b in self.by_residual[r]:
                if not (self.clusters[b] & cluster or self.saturated[b] & source_bit):
                    self._add(b, source, source_bit, cluster)
                    self._move(b, r - size)
                    return b
            r += 1
        b = len(self.residuals)
        self.residuals.append(0)
        self.clusters.append(0)
        self.saturated.append(0)
        self.counts.append({})
        self._add(b, source, source_bit, cluster)
        self._enter(b, self.capacity - size)
        return b

    def _add(self, b: int, source: int, source_bit: int, cluster: int) -> None:
        self.clusters[b] |= cluster
        n = self.counts[b].get(source, 0) + 1
        self.counts[b][source] = n
        if n >= self.max_per_source:
            self.saturated[b] |= source_bit


def _packed(groups: Iterator[pa.Table], capacity: int, max_per_source: int):
    for g in groups:
        rows = g.select(["source", "a", "b", "n_words", "row", "piece"]).to_pylist()
        sources: dict = {}
        uses: dict = {}
        for r in rows:
            uses[(r["a"], r["b"])] = uses.get((r["a"], r["b"]), 0) + 1
        bits: dict = {}
        shard = Shard(capacity, max_per_source)
        bins: list[int | None] = [None] * len(rows)
        order = sorted(
            range(len(rows)),
            key=lambda i: (-rows[i]["n_words"], rows[i]["a"], rows[i]["b"], rows[i]["row"], rows[i]["piece"]),
        )
        base = g.column("shard")[0].as_py() << 32
        for i in order:
            r = rows[i]
            if not r["n_words"]:
                continue
            c = (r["a"], r["b"])
            # A cluster met once in the shard cannot conflict and needs no bit.
            mask = (1 << bits.setdefault(c, len(bits))) if uses[c] > 1 else 0
            bins[i] = base + shard.place(
                r["n_words"], sources.setdefault(r["source"], len(sources)), mask
            )
        out = g.select(["doc_id", "source", "row", "piece", "first_word", "n_words"])
        out = out.append_column("bin", pa.array(bins, pa.int64()))
        yield from out.to_batches()


def pack(
    spark: SparkSession,
    docs: DataFrame,
    capacity: int = CAPACITY,
    max_per_source: int = MAX_PER_SOURCE,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    cluster: Column | None = None,
) -> DataFrame:
    """One row per piece: ``doc_id, source, row, piece, first_word, n_words, bin``.

    ``cluster`` gives the duplicate cluster of a row as a struct of two longs
    ``a, b``; by default equal texts (lower-cased words) are one cluster.
    """
    words = word_array(F.col(text_col))
    if cluster is None:
        cluster = text_key(F.lower(F.array_join(words, " ")))
    rows = stored(
        spark,
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            cluster.alias("cluster"),
            F.size(words).cast("long").alias("size"),
        ),
        "packing-rows",
    )
    pieces = F.greatest(F.lit(1), F.ceil(F.col("size") / capacity)).cast("int")
    count = rows.agg(F.coalesce(F.sum(pieces), F.lit(0))).first()[0]
    shards = max(1, -(-count // SHARD_ROWS))
    cut = rows.select(
        "row", "doc_id", "source", "size",
        F.col("cluster.a").alias("a"),
        F.col("cluster.b").alias("b"),
        F.explode(F.sequence(F.lit(0), pieces - 1)).alias("piece"),
    )
    first = F.col("piece").cast("long") * capacity
    dealt = cut.select(
        F.pmod(F.xxhash64("row", "piece"), F.lit(shards)).cast("long").alias("shard"),
        "doc_id", "source", "a", "b", "row", "piece",
        first.alias("first_word"),
        F.least(F.lit(capacity), F.col("size") - first).alias("n_words"),
    )
    kind = dict(dealt.dtypes)
    return grouped(
        dealt,
        ["shard"],
        lambda g: _packed(g, capacity, max_per_source),
        f"doc_id {kind['doc_id']}, source {kind['source']}, row long, piece int, "
        "first_word long, n_words long, bin long",
    )


def bin_fill(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``bins, words, fill``: how full the bins are on average."""
    bins = packed.where("bin is not null").groupBy("bin").agg(F.sum("n_words").alias("words"))
    return bins.agg(
        F.count("*").alias("bins"),
        F.sum("words").alias("words"),
        (F.sum("words") / (F.count("*") * capacity)).alias("fill"),
    )


def packed_documents(spark: SparkSession, docs: DataFrame, **how) -> DataFrame:
    """``doc_id, source, piece, first_word, n_words, bin`` of every document."""
    return pack(spark, docs, **how).drop("row")
