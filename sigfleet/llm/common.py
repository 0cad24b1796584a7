"""Column builders shared by the operators of this subpackage.

All of them treat a null text as empty and never read names other than the
ones passed in, so extra or clashing columns of the input are harmless.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sigfleet.session import work_path

# Characters that separate words: blank and tab to carriage return.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, a single file or a folder of files."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def word_array(text: Column) -> Column:
    """Maximal runs of non-space characters, in order."""
    return F.array_remove(F.split(whole(text), r"[\x20\x09-\x0D]+"), "")


def count_chars(text: Column, chars: str) -> Column:
    """How many characters of ``text`` are among ``chars``."""
    return F.length(text) - F.length(F.translate(text, chars, ""))


def packed_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, safe from clashing names."""
    return F.struct(*[F.col(f"`{c}`").alias(c) for c in df.columns])


def unpacked(column: str, names: list[str]) -> list[Column]:
    """The columns of a :func:`packed_row` again."""
    return [F.col(column)[c].alias(c) for c in names]


def text_key(text: Column) -> Column:
    """128-bit key of a text: equal texts, equal keys (null apart from '')."""
    return F.struct(
        F.xxhash64(text).alias("a"), F.xxhash64(F.lit("second"), text).alias("b")
    )


def stored(spark: SparkSession, df: DataFrame, kind: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage with a table that every executor can read again, so a
    lost executor costs a re-read and not a recomputation.
    """
    path = work_path(spark, f"llm-{kind}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
