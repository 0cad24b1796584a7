"""Encoding repair of landed JSON files (K8).

Reads every file under a folder whole (files are dealt over the tasks), drops
a leading UTF-8 byte-order mark, and writes the repaired files to a *new*
folder (the input is left untouched, which replaces the backup copy): each at
its own path below the input folder, byte for byte otherwise, whatever its
encoding. Files not matching the pattern are reported as ``skipped``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigfleet.sinks.named_files import qualified, read_whole_files, write_named_files

BOM_HEX = "EFBBBF"


def repair_status(spark: SparkSession, input_dir: str, pattern: str = "*.json") -> DataFrame:
    """Per file: ``(path, file, status, bytes_in, bytes_out, content)``;
    ``file`` is the path below ``input_dir``, status is ``repaired``,
    ``clean`` or ``skipped``."""
    root = qualified(spark, input_dir)
    files = read_whole_files(spark, input_dir).select(F.concat(F.lit(f"{root}/"), "file").alias("path"), "*")
    regex = "^" + pattern.replace(".", r"\.").replace("*", ".*").replace("?", ".") + "$"
    name = F.element_at(F.split("path", "/"), -1)
    has_bom = F.hex(F.substring("content", 1, 3)) == F.lit(BOM_HEX)
    matches = F.regexp_like(name, F.lit(regex))
    fixed = F.when(has_bom, F.expr("substring(content, 4)")).otherwise(F.col("content"))
    return files.select(
        "path",
        "file",
        F.when(~matches, "skipped").when(has_bom, "repaired").otherwise("clean").alias("status"),
        F.col("length").alias("bytes_in"),
        F.when(matches, F.length(fixed)).alias("bytes_out"),
        F.when(matches, fixed).alias("content"),
    )


def repair_bom(spark: SparkSession, input_dir: str, output_dir: str, pattern: str = "*.json") -> DataFrame:
    """Write repaired copies and return the per-file status rows.

    Every file keeps its path below ``input_dir``; paths of files are unique,
    so no file meets another.
    """
    st = repair_status(spark, input_dir, pattern)
    write_named_files(st.where(F.col("status") != "skipped"), output_dir, unique=True)
    return st.drop("content")
