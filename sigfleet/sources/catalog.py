"""Pump catalogue files.

A catalogue file is one JSON document, UTF-8 with or without a byte-order
mark: either a bare array of pump records or an object ``{"results": [...]}``;
any other shape holds no pumps. Each record has ``id``, ``name`` and one
``{"href": ...}`` object per signal key.

Files are read whole (``wholetext``), one task per file; records come out
with their file and position so "last record wins" (A5) is well defined.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException, PySparkException

from sigfleet.functions.links import discovered_links
from sigfleet.operators.catalog_ops import with_fallback
from sigfleet.operators.reports import dedupe_last
from sigfleet.schemas import BOM, DEFAULT_PUMP_TYPE
from sigfleet.sinks.named_files import path_below
from sigfleet.sources.payloads import is_json

CATALOG_COLUMNS = ["pump_id", "name", "pump_type", "links", "source_file", "source_pos"]
_EMPTY_DDL = "pump_id string, name string, pump_type string, links map<string,string>, source_file string, source_pos long"


def _documents(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.text(path, wholetext=True)
    return raw.select(
        F.regexp_replace("value", "^" + BOM, "").alias("doc"),
        F.col("_metadata.file_path").alias("source_file"),
    )


def catalog_records(docs: DataFrame, *more: str) -> DataFrame:
    """Records of catalogue documents ``(doc, source_file)``; ``more`` columns
    of the documents come along."""
    doc = F.col("doc")
    head = F.substring(F.regexp_replace(doc, r"^\s+", ""), 1, 1)
    arr = F.when(head == "[", doc).when(head == "{", F.get_json_object(doc, "$.results"))
    # Record by record: one that is no object is left out alone.
    recs = docs.select("source_file", *more, F.from_json(arr, "array<string>").alias("_a"))
    x = (
        recs.select("source_file", *more, F.posexplode("_a").alias("source_pos", "_e"))
        .where(F.ltrim("_e").startswith("{"))
        .withColumn("_m", F.from_json("_e", "map<string,string>"))
        .where(F.col("_m").isNotNull())
    )
    m = F.col("_m")
    return x.select(
        m["id"].alias("pump_id"),
        m["name"].alias("name"),
        F.coalesce(m["type"], F.lit(DEFAULT_PUMP_TYPE)).alias("pump_type"),
        F.map_filter(m, lambda k, v: ~k.isin("id", "name", "type")).alias("links"),
        "source_file",
        F.col("source_pos").cast("long").alias("source_pos"),
        *more,
    )


def catalog_links(catalog: DataFrame) -> DataFrame:
    """Long form ``(pump_id, signal, detailed, href)`` of the discovered links
    (F8): only entries whose value is an object holding ``href``."""
    x = catalog.select("pump_id", F.explode(discovered_links("links")).alias("key", "href"))
    return x.select(
        "pump_id",
        F.regexp_replace("key", "/detailed$", "").alias("signal"),
        F.col("key").endswith("/detailed").alias("detailed"),
        "href",
    )


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the catalogue file(s) at ``path``.

    A missing path gives no rows (as a failed file read does upstream).
    """
    try:
        docs = _documents(spark, path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _EMPTY_DDL)
    return catalog_records(docs)


def latest_catalog(records: DataFrame) -> DataFrame:
    """A5 over catalogue records: one row per id, the last record wins
    (order: file path, then position in the file)."""
    r = records.withColumn("_order", F.struct("source_file", "source_pos"))
    d = dedupe_last(r, "pump_id", "_order", ["name", "pump_type", "links", "source_file", "source_pos"])
    return d.drop("_order")


def catalog_with_fallback(spark: SparkSession, primary_path: str, snapshot_path: str) -> DataFrame:
    """The primary catalogue unless it cannot be read at all, then the
    local snapshot. An unexpected shape or an empty list does *not* fall
    back. ``origin`` tells which one answered."""
    try:
        docs = _documents(spark, primary_path)
        docs.limit(1).count()  # forces listing; a transport-level failure raises here
        return catalog_records(docs).withColumn("origin", F.lit("primary"))
    except (PySparkException, Py4JJavaError):  # missing, unreadable or broken storage
        return read_catalog(spark, snapshot_path).withColumn("origin", F.lit("snapshot"))


# --- S2 by file ---------------------------------------------------------------

_LOADED_DDL = "file string, source_file string, doc string"


def _file_names(spark: SparkSession, root: str) -> DataFrame:
    """The files with content below ``root`` by their path (no file is opened)."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "file string")
    return files.select(path_below(spark, root).alias("file"))


def loaded_documents(spark: SparkSession, root: str) -> DataFrame:
    """``file, source_file, doc`` of the files below ``root`` that can be read.

    A file whose reading fails (broken compression or checksum, gone since the
    listing) costs only itself: it has no row. A missing folder has no rows.
    """
    guarded = {"recursiveFileLookup": True, "ignoreCorruptFiles": True, "ignoreMissingFiles": True}
    try:
        raw = spark.read.options(**guarded).text(root, wholetext=True)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LOADED_DDL)
    source = F.col("_metadata.file_path")
    raw = raw.select(source.alias("source_file"), F.regexp_replace("value", "^" + BOM, "").alias("doc"))
    return raw.select(path_below(spark, root, "source_file").alias("file"), "source_file", "doc")


def load_outcomes(documents: DataFrame, *names: DataFrame) -> DataFrame:
    """``file, outcome`` of every file in ``names``, one row per file.

    ``ok`` holds pump records, ``empty`` is JSON of another shape or without
    any, ``error`` could not be read or is not JSON (a download cut short).
    """
    expected = names[0].select("file")
    for other in names[1:]:
        expected = expected.unionByName(other.select("file"))
    listed = F.when(F.ltrim("doc").startswith("["), F.col("doc")).otherwise(F.get_json_object("doc", "$.results"))
    records = F.coalesce(F.json_array_length(listed), F.lit(0))
    seen = documents.select(
        "file", F.when(~is_json("doc"), "error").when(records > 0, "ok").otherwise("empty").alias("outcome")
    )
    return expected.distinct().join(seen, "file", "left").select("file", F.coalesce("outcome", F.lit("error")).alias("outcome"))


def catalog_with_file_fallback(spark: SparkSession, primary_path: str, snapshot_path: str) -> DataFrame:
    """S2 by file: the records of each primary file, or those of the snapshot
    file of the same path where the primary one is missing, cannot be read or
    is not JSON. ``origin`` tells which one answered, ``file`` the path.

    An empty list or another shape answers (with no records), as in the form
    for whole loads. Files of zero bytes count as not read. A snapshot file
    that fails as well gives no records.
    """
    documents = loaded_documents(spark, primary_path)
    backup = loaded_documents(spark, snapshot_path)
    outcomes = load_outcomes(documents, _file_names(spark, primary_path), _file_names(spark, snapshot_path))
    tagged = lambda df, origin: df.withColumn("origin", F.lit(origin))
    docs = with_fallback(tagged(documents, "primary"), tagged(backup, "snapshot"), outcomes, "file")
    return catalog_records(docs, "file", "origin")
