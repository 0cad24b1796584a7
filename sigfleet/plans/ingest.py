"""Ingestion jobs: landed files -> canonical tables.

* payloads -> ``readings`` (an append log partitioned by signal and day, see
  ``sigfleet.sources.readings_log``) and ``fetch_outcomes`` (partitioned
  by signal);
* catalogue files -> ``pumps`` (one row per id, last record wins, records
  without id dropped) and ``pump_links`` (long form of the discovered links).

Each output is written by Spark's distributed writer. The landed payloads are
parsed once, into a table in the shared folder that both outputs of the job
read (the readings twice, since their ranges are sampled); it is dropped at
the end. An executor loss only re-runs tasks.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigfleet.operators.catalog_ops import valid_ids
from sigfleet.sources.catalog import catalog_links, latest_catalog, read_catalog
from sigfleet.session import work_path
from sigfleet.sources.payloads import OUTCOME, parsed, readings_of_parsed
from sigfleet.sources.readings_log import append_readings, payload_id


OUTCOME_FILES = 8


def ingest_payloads(
    landed: DataFrame, readings_path: str, outcomes_path: str, files: int | None = None, run: int | None = None
) -> None:
    """Add landed payloads to the readings and outcomes tables.

    Readings are appended as a run of their own and resolved when read, so a
    repeated or overlapping landing adds nothing twice, nothing of a landing is
    lost, and no earlier file is touched. A job that may run again passes its
    ``run`` number. Outcomes are a log of fetches: a fetch (pump, signal,
    detailed, time of fetching) landed again replaces nothing and is dropped.
    """
    spark = landed.sparkSession
    kept = work_path(spark, "parsed")
    try:
        parsed(landed.withColumn("payload", payload_id()), "payload").write.parquet(kept)
        payloads = spark.read.parquet(kept)
        append_readings(readings_of_parsed(payloads, "payload"), readings_path, run=run, files=files)
        _append_outcomes(payloads, outcomes_path)
    finally:
        p = spark._jvm.org.apache.hadoop.fs.Path(kept)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _append_outcomes(payloads: DataFrame, outcomes_path: str) -> None:
    """The outcomes of the fetches that the log does not have yet."""
    new = payloads.select("pump_id", "signal", "detailed", "fetched_at", *OUTCOME).withColumn("day", F.to_date("fetched_at"))
    key = ["pump_id", "signal", "detailed", "fetched_at"]
    new = new.groupBy("day", *key).agg(
        F.max(F.struct(*[c for c in new.columns if c not in ("day", *key)])).alias("_o")
    ).select("day", *key, "_o.*")
    spark = payloads.sparkSession
    try:
        old = spark.read.parquet(outcomes_path).select("day", *key)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    else:
        same = " and ".join(f"n.{c} <=> o.{c}" for c in ["day", *key])
        new = new.alias("n").join(old.alias("o"), F.expr(same), "left_anti")
    dealt = new.repartition("signal", "day", F.pmod(F.xxhash64("pump_id"), F.lit(OUTCOME_FILES)))
    dealt.write.mode("append").partitionBy("signal", "day").parquet(outcomes_path)


def ingest_catalog(spark: SparkSession, catalog_path: str, pumps_path: str, links_path: str) -> None:
    """Catalogue files into the pumps and pump_links tables."""
    pumps = valid_ids(latest_catalog(read_catalog(spark, catalog_path)))
    pumps.select("pump_id", "name", "pump_type", "source_file", "source_pos").write.mode("overwrite").parquet(pumps_path)
    catalog_links(pumps).write.mode("overwrite").parquet(links_path)
