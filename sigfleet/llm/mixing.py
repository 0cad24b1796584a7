"""Mixing sources to target weights by weighted fair queueing.

Every document of a source stands in that source's queue in a fixed shuffled
order (by digest). A document that ends after ``c`` words of its queue has
the virtual finish time ``c / weight``; a queue is run through up to
``max_repeats`` times. All items are range-sorted by virtual finish time and
taken until the budget is used up; the item at the border is taken in part.
A queue that runs dry leaves its share to the others, which is exactly the
resharing of capped targets by weight.

Built-in functions only. No window runs over a whole source or over all
items: positions inside a queue come from digest buckets plus bucket offsets,
positions in the global order from range partitions plus partition offsets.
The tables of buckets and partitions are counts, thousands of times smaller
than the documents.

Defined cases: a null or blank text has size 0 and is never taken; the null
source is a source of its own, last in order; repeated rows are queued each
for itself; an empty table gives an empty result; a total of 0 gives targets
of 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sigfleet.llm.common import packed_row, stored, unpacked, whole, word_array

WEIGHTS = (5.0, 2.0, 1.0)
ROWS_PER_BUCKET = 16_384


def digest(id_col: Column, text: Column) -> Column:
    """Shuffle key of a row; rows that agree in it are interchangeable."""
    return F.md5(F.concat(F.coalesce(id_col.cast("string"), F.lit("")), F.lit(":"), whole(text)))


def _bucket_digits(rows: int) -> int:
    """Hex digits of the digest that make a bucket of about ROWS_PER_BUCKET."""
    digits = 0
    while rows > ROWS_PER_BUCKET * 16**digits:
        digits += 1
    return digits


def source_targets(
    sizes: DataFrame, weights: Sequence[float], max_repeats: int, share: float
) -> DataFrame:
    """One row per source: rank, weight, size, target and the budget.

    ``sizes(source, source_size)`` has one row per source, so its windows
    run over the sources and not over documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.array(*[F.lit(float(x)) for x in weights])
    s = sizes.withColumn("rank", F.row_number().over(by_name)).withColumn(
        "weight", F.get(w, F.pmod(F.col("rank") - 1, F.lit(len(weights))))
    )
    cap = F.col("source_size") * max_repeats
    s = s.withColumn("cap", cap).withColumn("ratio", F.col("cap") / F.col("weight"))
    order = Window.orderBy("ratio", "rank")
    everything = Window.partitionBy()
    s = (
        s.withColumn("budget", F.floor(F.sum("source_size").over(everything) * share).cast("long"))
        .withColumn(
            "capped",
            F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        )
        .withColumn("open", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("budget") - F.col("capped")) / F.col("open"))
        .withColumn("free", F.col("level") * F.col("weight") <= F.col("cap"))
    )
    # The water level is that of the first source, by ratio, below its cap.
    first = F.min(F.when(F.col("free"), F.struct("ratio", "rank", "level"))).over(everything)
    s = s.withColumn("first", first)
    below = (F.col("ratio") < F.col("first.ratio")) | (
        (F.col("ratio") == F.col("first.ratio")) & (F.col("rank") < F.col("first.rank"))
    )
    target = F.when(
        F.col("first").isNull() | below, F.col("cap").cast("double")
    ).otherwise(F.col("first.level") * F.col("weight"))
    return s.select("source", "rank", "weight", "source_size", "budget", target.alias("target"))


def mix(
    spark: SparkSession,
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    max_repeats: int = 3,
    share: float = 1.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per document: ``doc_id, digest, source, size, source_size,
    target, taken``.

    ``taken`` counts the words the mix takes of the document over all passes.
    """
    text = F.col(text_col)
    rows = stored(
        spark,
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            F.size(word_array(text)).cast("long").alias("size"),
            digest(F.col(id_col), text).alias("digest"),
        ),
        "mix-rows",
    )
    digits = _bucket_digits(rows.count())
    rows = rows.withColumn("bucket", F.substring("digest", 1, digits))

    buckets = rows.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = buckets.withColumn(
        "offset", F.coalesce(F.sum("bucket_size").over(before), F.lit(0))
    )
    sizes = buckets.groupBy("source").agg(F.sum("bucket_size").alias("source_size"))
    targets = source_targets(sizes, weights, max_repeats, share)
    places = (
        offsets.alias("o")
        .join(targets.alias("t"), F.expr("o.source <=> t.source"))
        .select("o.source", "bucket", "offset", "rank", "weight", "source_size", "budget", "target")
    )

    queue = Window.partitionBy("source", "bucket").orderBy("digest", "size")
    queued = rows.withColumns(
        {
            "within": F.sum("size").over(queue.rowsBetween(Window.unboundedPreceding, 0)),
            "place": F.row_number().over(queue),
        }
    )
    turn = F.col("turn")
    finish = (turn * F.col("source_size") + F.col("offset") + F.col("within")) / F.col("weight")
    items = (
        queued.alias("q")
        .join(places.alias("p"), F.expr("q.source <=> p.source and q.bucket = p.bucket"))
        .select(
            "doc_id", "digest", "q.source", "q.bucket", "place", "size", "rank", "source_size",
            "budget", "target", "weight", "offset", "within",
            F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))).alias("turn"),
        )
        .withColumn("finish", finish)
        .drop("weight", "offset", "within")
    )
    order = ["finish", "rank", "digest", "size", "place", "turn"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    # Written with the range partition's number: totals and positions below
    # then refer to the same partitions, also after a retry.
    items = stored(
        spark,
        items.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()),
        "mix-items",
    )
    totals = items.groupBy("part").agg(F.sum("size").alias("part_size"))
    starts = totals.select(
        "part",
        F.coalesce(
            F.sum("part_size").over(
                Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("start"),
    )
    position = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.col("start") + F.coalesce(F.sum("size").over(position), F.lit(0))
    taken = F.greatest(F.lit(0), F.least(F.col("size"), F.col("budget") - ahead))
    return (
        items.join(starts, "part")
        .withColumn("part_taken", taken)
        .groupBy("source", "bucket", "place", "doc_id", "digest", "size", "source_size", "target")
        .agg(F.sum("part_taken").cast("long").alias("taken"))
        .select("doc_id", "digest", "source", "size", "source_size", "target", "taken")
    )


def mix_documents(spark: SparkSession, docs: DataFrame, **how) -> DataFrame:
    """The documents of the mix, each as often as it is taken.

    The border item, taken in part, counts as taken when at least half of it
    is. Columns are those of ``docs``.
    """
    id_col, text_col = how.get("id_col", "doc_id"), how.get("text_col", "text")
    copies = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    mixed = (
        mix(spark, docs, **how)
        .where("size > 0 and taken > 0")
        .select("digest", copies.alias("copies"))
        .where("copies > 0")
        .groupBy("digest")
        .agg(F.sort_array(F.collect_list("copies")).alias("mix_copies"))
    )
    packed = docs.select(
        digest(F.col(id_col), F.col(text_col)).alias("digest"),
        packed_row(docs).alias("row"),
    )
    # Rows that agree in id and text share one list: the n-th takes its n-th count.
    nth = F.row_number().over(Window.partitionBy("digest").orderBy("digest"))
    return (
        packed.join(mixed, "digest")
        .withColumn("nth", nth)
        .withColumn("times", F.coalesce(F.get("mix_copies", F.col("nth") - 1), F.lit(0)))
        .where("times > 0")
        .select(F.col("row"), F.explode(F.sequence(F.lit(1), F.col("times"))))
        .select(*unpacked("row", docs.columns))
    )
