"""Token counts: an exact length histogram and its suffix sums.

Every document is encoded once, whole; the lengths are aggregated into one
row per length, and suffix sums over that histogram answer, for every context
limit at once, how many documents fit, how many tokens they hold, how many
tokens remain when longer documents are truncated, and which quantile the
limit is. Limits between two lengths follow from the row of the next smaller
length (:func:`at_limits`).

The tokenizer is a vocabulary file given by path; a local path is opened by the
driver itself, any other by Spark, and its lines are broadcast (a file of fixed
size, about 1 MB), so executors need no copy. The histogram has one row per different length; its suffix sums run
inside blocks of ``BLOCK`` lengths plus one total per block, never over all
documents.

Defined cases: a null or empty text has 0 tokens; special token strings in a
text are ordinary text; an empty table gives an empty histogram.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLOCK = 256
# Fixed value: the split pattern that belongs to the vocabulary's merges.
PATTERN = (
    r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def _ranks(lines: list[str]) -> dict[bytes, int]:
    pairs = (line.split() for line in lines if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def vocabulary_lines(spark: SparkSession, path: str) -> list[str]:
    """Lines of the vocabulary; a plain or ``file:`` path is one of the driver's."""
    where = urlsplit(path)
    if where.scheme in ("", "file"):
        with open(where.path, encoding="ascii") as f:
            return f.read().splitlines()
    return [r[0] for r in spark.read.text(path).collect()]  # one file of ~50,000 lines


def lengths(
    spark: SparkSession,
    docs: DataFrame,
    vocabulary: str,
    text_col: str = "text",
    pattern: str = PATTERN,
) -> DataFrame:
    """``length``: tokens of every document, one row each."""
    shared = spark.sparkContext.broadcast(vocabulary_lines(spark, vocabulary))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        encoder = tiktoken.Encoding(
            "corpus", pat_str=pattern, mergeable_ranks=_ranks(shared.value), special_tokens={}
        )
        for batch in batches:
            n = [
                len(encoder.encode_ordinary(t.as_py())) if t.is_valid else 0
                for t in batch.column(0)
            ]
            yield pa.RecordBatch.from_pydict({"length": pa.array(n, pa.int64())})

    return docs.select(F.col(text_col).alias("text")).mapInArrow(encode, "length long")


def histogram(lengths_: DataFrame) -> DataFrame:
    """``length, n_docs``, one row per length."""
    return lengths_.groupBy("length").agg(F.count("*").alias("n_docs"))


def totals(hist: DataFrame) -> DataFrame:
    """The histogram with its running and suffix sums.

    For the row's length ``L`` as context limit: ``docs_within`` and
    ``tokens_within`` (documents of at most ``L`` tokens), ``docs_over`` and
    ``tokens_over``, ``truncated_tokens`` (sum of ``min(length, L)``) and
    ``quantile`` (``docs_within`` over all documents).
    """
    h = hist.withColumn("tokens", F.col("length") * F.col("n_docs")).withColumn(
        "block", F.floor(F.col("length") / BLOCK)
    )
    after = Window.orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    whole = Window.partitionBy()
    # One row per block of lengths: the longest text over BLOCK rows at most.
    blocks = (
        h.groupBy("block")
        .agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
        .select(
            "block",
            F.coalesce(F.sum("d").over(after), F.lit(0)).alias("docs_after"),
            F.coalesce(F.sum("t").over(after), F.lit(0)).alias("tokens_after"),
            F.sum("d").over(whole).alias("all_docs"),
            F.sum("t").over(whole).alias("all_tokens"),
        )
    )
    longer = Window.partitionBy("block").orderBy("length").rowsBetween(1, Window.unboundedFollowing)
    docs_over = F.coalesce(F.sum("n_docs").over(longer), F.lit(0)) + F.col("docs_after")
    tokens_over = F.coalesce(F.sum("tokens").over(longer), F.lit(0)) + F.col("tokens_after")
    return (
        h.join(blocks, "block")
        .withColumn("docs_over", docs_over)
        .withColumn("tokens_over", tokens_over)
        .select(
            "length",
            "n_docs",
            (F.col("all_docs") - F.col("docs_over")).alias("docs_within"),
            (F.col("all_tokens") - F.col("tokens_over")).alias("tokens_within"),
            "docs_over",
            "tokens_over",
            (
                F.col("all_tokens") - F.col("tokens_over") + F.col("docs_over") * F.col("length")
            ).alias("truncated_tokens"),
            ((F.col("all_docs") - F.col("docs_over")) / F.col("all_docs")).alias("quantile"),
        )
    )


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """Answers for any context limits: ``limit`` and what fits or is cut."""
    ask = F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits]))
    below = sums.select("*", ask.alias("limit"))
    best = F.max(
        F.when(
            F.col("length") <= F.col("limit"),
            F.struct("length", "docs_within", "tokens_within", "docs_over"),
        )
    )
    rows = below.groupBy("limit").agg(
        best.alias("b"), F.max(F.col("docs_within")).alias("all_docs")
    )
    over = F.coalesce(F.col("b.docs_over"), F.col("all_docs"))
    return rows.select(
        "limit",
        F.coalesce("b.docs_within", F.lit(0)).alias("docs_within"),
        F.coalesce("b.tokens_within", F.lit(0)).alias("tokens_within"),
        over.alias("docs_over"),
        (F.coalesce("b.tokens_within", F.lit(0)) + over * F.col("limit")).alias("truncated_tokens"),
    )
