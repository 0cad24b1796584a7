"""Exact top-k search by inner product over an M-tree.

The root of the tree has at most ``MAX_CELLS`` routing objects (a bounded
sample of the vectors; every vector is indexed under its nearest one). A cell
is cut into blocks of about ``BLOCK_ROWS`` vectors; each block is an M-tree
of pages of its own (:mod:`sigfleet.llm.mtree`), built in one task and
written to the shared folder. Search is best first on both levels: a query
first searches the block it lies in, which gives it a score that ``k``
vectors reach; it is then sent only to cells whose covering radius lets them
hold a better one, and inside a block visits pages in order of their bound.

A block meets its queries in chunks of ``QUERY_CHUNK``; the largest thing a
task holds is one block and one chunk. The driver sees the routing objects
and one row per cell.

Defined cases: vectors that are null, or hold a null or non-finite component,
and rows with a null id take no part; vectors of different lengths compare as
if padded with zeros; of rows that repeat an id each is a query and a
candidate of its own (a query leaves out its own row only); with fewer than
``k`` candidates all are returned; scores must fit 64 bits.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sigfleet.llm.common import stored
from sigfleet.llm.groups import grouped
from sigfleet.llm.mtree import MTree, lift

BLOCK_ROWS = 8_192
MAX_CELLS = 256
MIN_CELLS = 8
QUERY_CHUNK = 4_096


def integer_vectors(spark: SparkSession, vectors: DataFrame, id_col: str, vec_col: str, scale: float):
    """Stored ``row, vec_id, v`` of the rows that take part, v as floor(scale x)."""
    v = F.col(vec_col).cast("array<double>")
    usable = F.col(id_col).isNotNull() & F.coalesce(
        F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))) & ~F.isnan(x)),
        F.lit(False),
    )
    return stored(
        spark,
        vectors.where(usable).select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).cast("long").alias("vec_id"),
            F.transform(v, lambda x: F.floor(x * F.lit(float(scale))).cast("long")).alias("v"),
        ),
        "topk-vectors",
    )


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    out = np.zeros((len(column), dim), np.int64)
    for i, x in enumerate(column.to_pylist()):
        out[i, : len(x)] = x
    return out


def _assign(batches, routing: np.ndarray, radius2: float, dim: int):
    """Nearest routing object of each vector, and the distance to it."""
    for b in batches:
        if not b.num_rows:
            continue
        x = lift(_matrix(b.column("v"), dim), radius2)
        square = (x**2).sum(axis=1)[:, None] + (routing**2).sum(axis=1)[None, :]
        cell = np.argmin(square - 2.0 * (x @ routing.T), axis=1)
        d = np.sqrt(((x - routing[cell]) ** 2).sum(axis=1))
        yield pa.RecordBatch.from_arrays(
            [b.column("row"), b.column("vec_id"), b.column("v"),
             pa.array(cell.astype(np.int32)), pa.array(d)],
            ["row", "vec_id", "v", "cell", "distance"],
        )


def _trees(groups: Iterator[pa.Table], radius2: float, dim: int):
    for g in groups:
        tree = MTree(_matrix(g.column("v"), dim), g.column("vec_id").to_numpy(), radius2)
        rows = g.column("row").to_numpy()
        yield pa.RecordBatch.from_pydict(
            {
                "block": pa.array([g.column("block")[0].as_py()], pa.int64()),
                "tree": pa.array([pickle.dumps((tree.state(), rows), protocol=5)], pa.binary()),
            }
        )


def _searched(groups: Iterator[pa.Table], radius2: float, dim: int, k: int):
    """Best k of one block for each query of one chunk."""
    for g in groups:
        trees = [x for x in g.column("tree") if x.is_valid]
        asked = g.filter(pc.is_null(g.column("tree")))
        if not trees or not asked.num_rows:
            continue
        state, rows = pickle.loads(trees[0].as_py())
        tree = MTree.from_state(state)
        place = {int(r): i for i, r in enumerate(rows)}
        queries = _matrix(asked.column("v"), dim)
        out: dict[str, list] = {"row": [], "query_id": [], "vec_id": [], "score": []}
        ids = asked.column("vec_id").to_pylist()
        for i, (row, at_least) in enumerate(
            zip(asked.column("row").to_pylist(), asked.column("at_least").to_pylist(), strict=True)
        ):
            own = place.get(row, -1)
            for s, vec_id, _ in tree.search(queries[i], (own,), k, radius2, at_least):
                out["row"].append(row)
                out["query_id"].append(ids[i])
                out["vec_id"].append(vec_id)
                out["score"].append(-s)
        yield pa.RecordBatch.from_pydict({c: pa.array(v, pa.int64()) for c, v in out.items()})


FOUND = "row long, query_id long, vec_id long, score long"


def _search(
    trees: DataFrame, asked: DataFrame, chunks: int, radius2: float, dim: int, k: int
) -> DataFrame:
    """``asked(block, row, vec_id, v, at_least)`` against the trees of their blocks."""
    asked = asked.withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(chunks)).cast("long"))
    needed = asked.select("block", "chunk").distinct()
    pages = trees.join(needed, "block").select(
        "block", "chunk",
        F.lit(None).cast("long").alias("row"),
        F.lit(None).cast("long").alias("vec_id"),
        F.lit(None).cast("array<long>").alias("v"),
        F.lit(None).cast("long").alias("at_least"),
        "tree",
    )
    rows = pages.unionByName(
        asked.select("block", "chunk", "row", "vec_id", "v", "at_least").withColumn(
            "tree", F.lit(None).cast("binary")
        )
    )
    return grouped(
        rows, ["block", "chunk"], lambda g: _searched(g, radius2, dim, k), FOUND
    )


def top_k(
    spark: SparkSession,
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    scale: float = 1024.0,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best of every query.

    ``is_query`` is a condition on the column ``vec_id``. Ties go to the
    smaller id.
    """
    base = integer_vectors(spark, vectors, id_col, vec_col, scale)
    square = F.aggregate(
        "v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")
    )
    n, radius2, dim = base.agg(
        F.count("*"), F.max(square), F.max(F.size("v"))
    ).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not n:
        return empty
    radius2, dim = float(radius2), max(1, int(dim))
    cells = max(MIN_CELLS, min(MAX_CELLS, -(-n // BLOCK_ROWS)))
    picked = base.orderBy(F.xxhash64("row"), "row").limit(cells).select("v").collect()
    routing = lift(_matrix(pa.array([r["v"] for r in picked]), dim), radius2)

    placed = stored(
        spark,
        base.mapInArrow(
            lambda it: _assign(it, routing, radius2, dim),
            "row long, vec_id long, v array<long>, cell int, distance double",
        ),
        "topk-placed",
    )
    per_cell = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("distance").alias("r"))
    root = {r["cell"]: (-(-r["n"] // BLOCK_ROWS), r["r"]) for r in per_cell.collect()}
    blocks_of = F.create_map(*[F.lit(x) for c, (b, _) in root.items() for x in (c, b)])
    salt = F.pmod(F.xxhash64("row"), F.try_element_at(blocks_of, F.col("cell")))
    blocked = placed.withColumn("block", F.col("cell").cast("long") * (1 << 32) + salt)
    trees = stored(
        spark,
        grouped(
            blocked.select("block", "row", "vec_id", "v"),
            ["block"],
            lambda g: _trees(g, radius2, dim),
            "block long, tree binary",
        ),
        "topk-trees",
    )
    queries = blocked.where(is_query).select("block", "cell", "row", "vec_id", "v")
    chunks = max(1, -(-queries.count() // QUERY_CHUNK))

    home = queries.withColumn("at_least", F.lit(None).cast("long"))
    near = stored(spark, _search(trees, home, chunks, radius2, dim, k), "topk-home")
    reached = near.groupBy("row").agg(
        F.min("score").alias("worst"), F.count("*").alias("found")
    )
    known = queries.join(reached, "row", "left").select(
        "block", "row", "vec_id", "v", F.when(F.col("found") >= k, F.col("worst")).alias("at_least")
    )

    def routed(batches):
        """Each query with the blocks of all cells that may hold a better vector."""
        order = sorted(root)
        centers = routing[order]
        radii = np.array([root[c][1] for c in order])
        counts = [root[c][0] for c in order]
        for b in batches:
            if not b.num_rows:
                continue
            q = _matrix(b.column("v"), dim).astype(np.float64)
            q = np.hstack([q, np.zeros((len(q), 1))])
            take, block = [], []
            home_block = b.column("block").to_pylist()
            floor = b.column("at_least").to_pylist()
            for i in range(len(q)):
                d = np.sqrt(((centers - q[i]) ** 2).sum(axis=1))
                limit = MTree._reach(floor[i], float(q[i] @ q[i]), radius2)
                for j in np.flatnonzero(d - radii - 1e-9 * (d + 1.0) <= limit):
                    for s in range(counts[j]):
                        x = (order[j] << 32) + s
                        if x != home_block[i]:
                            take.append(i)
                            block.append(x)
            out = b.take(pa.array(take, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(block, pa.int64()), *[out.column(c) for c in ("row", "vec_id", "v", "at_least")]],
                ["block", "row", "vec_id", "v", "at_least"],
            )

    rest = known.mapInArrow(
        routed, "block long, row long, vec_id long, v array<long>, at_least long"
    )
    found = near.unionByName(_search(trees, rest, chunks, radius2, dim, k))
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
